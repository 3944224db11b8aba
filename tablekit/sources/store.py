"""Small files of a table, through Arrow's file systems; data files are read and written by Spark."""

from __future__ import annotations

import os
import uuid

import pyarrow.fs as pafs


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), os.path.abspath(uri))


class Store:
    def exists(self, path: str) -> bool:
        fs, p = file_system(path)
        return fs.get_file_info(p).type != pafs.FileType.NotFound

    def make(self, path: str) -> None:
        fs, p = file_system(path)
        fs.create_dir(p, recursive=True)

    def read(self, path: str) -> str:
        fs, p = file_system(path)
        with fs.open_input_stream(p) as f:
            return f.read().decode()

    def create(self, path: str, text: str) -> bool:
        """Publishes a new file whole; False if there is one already.

        Locally a hard link publishes it, which fails if the name is taken.  Other
        stores offer no such call through Arrow: there the name is looked up right
        before the move, and writers of one table must not commit at the same moment.
        """
        fs, p = file_system(path)
        if self.exists(path):
            return False
        folder, name = p.rsplit("/", 1)
        temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(temporary) as f:
            f.write(text.encode())
        if not isinstance(fs, pafs.LocalFileSystem):
            taken = self.exists(path)
            fs.delete_file(temporary) if taken else fs.move(temporary, p)
            return not taken
        try:
            os.link(temporary, p)
            return True
        except FileExistsError:  # another writer was first
            return False
        finally:
            os.remove(temporary)

    def delete(self, path: str) -> None:
        fs, p = file_system(path)
        kind = fs.get_file_info(p).type
        if kind == pafs.FileType.Directory:
            fs.delete_dir(p)
        elif kind == pafs.FileType.File:
            fs.delete_file(p)

    def names(self, path: str) -> list[str]:
        fs, p = file_system(path)
        return [x.base_name for x in fs.get_file_info(pafs.FileSelector(p, allow_not_found=True))]

    def files(self, path: str) -> list[tuple[str, int]]:
        """(path, bytes) of all files below, without hidden ones; paths begin as the one given does."""
        fs, p = file_system(path)
        found = fs.get_file_info(pafs.FileSelector(p, allow_not_found=True, recursive=True))
        return [(path + x.path[len(p) :], x.size) for x in found if x.is_file and not x.base_name.startswith((".", "_"))]
