"""Helpers the operators share: inputs, scratch tables, labels, and word hashing on Arrow buffers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of ids and the like are broadcast up to this many bytes; beyond it the join shuffles.
BROADCAST_BYTES = 64 << 20
#: Texts are worked on in pieces of about this many bytes, or one whole text if that is longer.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Where the setting is missing, a local session (as in tests) gets a folder
    of its own; a cluster without the setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tablekit-")
    spark.sparkContext.setCheckpointDir(f"file://{made}")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; the folder named after the application may go when it has ended."""
    return f"{shared_dir(spark)}/tablekit-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a written table in the shared folder: its lineage is cut, and lost executors cost nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(table: DataFrame) -> None:
    """Takes the space of a table of `written` that is read no more, and lets Spark drop shuffles nothing refers to."""
    folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    spark = table.sparkSession
    for folder in folders:
        spark.createDataFrame([], table.schema).write.mode("overwrite").parquet(folder)
    spark._jvm.System.gc()


def broadcast_if_small(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, to be broadcast if its rows, of `row_bytes` in memory each, are counted to fit `most` bytes."""
    return F.broadcast(df) if df.count() * row_bytes <= most else df


def text_digest(text: Column) -> Column:
    """128 bits of SHA-256: the identity of a text."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


# --- words of UTF-8 texts, without a Python object for each -----------------------------------

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_GOLDEN = 0x9E3779B97F4A7C15
#: Bytes of words: digits, letters, and every byte of a non-ASCII character; A-Z are lower-cased.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = True
_IN_WORD[128:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: a bijection on 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def multipliers(n: int, stream: int = 0) -> np.ndarray:
    """n odd 64-bit numbers, the same on every machine."""
    at = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(stream << 32)
    return mix64(at * np.uint64(_GOLDEN)) | np.uint64(1)


_PLACE = multipliers(64)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = multipliers(2 * n)
    return _PLACE


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its values; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def pieces(offs: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of at most `most` bytes together, or one longer text."""
    at, n = 0, len(offs) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, side="right")) - 1)
        yield at, to
        at = to


class Words:
    """The words of some texts: byte ranges, 64-bit hashes, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        n = len(data)
        inside = _IN_WORD[data]
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1] | edge[1:n]
            last[:-1] &= ~inside[1:] | edge[1:n]
        self.data = data
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, offs)
        lengths = self.ends - self.starts
        if len(lengths):
            packed = np.concatenate(([0], np.cumsum(lengths)))
            place = np.arange(packed[-1]) - np.repeat(packed[:-1], lengths)
            value = (_LOWER[data[inside]].astype(np.uint64) + np.uint64(1)) * _places(int(lengths.max()))[place]
            self.hashes = mix64(np.add.reduceat(value, packed[:-1]) + lengths.astype(np.uint64))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k words from each word on, and whether they all lie in one text."""
        n = len(self.hashes)
        m = max(0, n - k + 1)
        total = np.zeros(m, np.uint64)
        for j, c in enumerate(multipliers(k, 1)):
            total += self.hashes[j : j + m] * c
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        return mix64(total), text[:m] == text[k - 1 :] if m else np.zeros(0, bool)

    def strings(self, a: int, b: int) -> list[bytes]:
        raw = self.data
        return [_LOWER[raw[s:e]].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b])]


def shingles(words: Words, i: int, k: int, grams: np.ndarray) -> np.ndarray:
    """The k-word shingles of text i in order; a text of fewer words, but not none, has one of all of them."""
    a, b = int(words.first[i]), int(words.first[i + 1])
    if b - a >= k:
        return grams[a : b - k + 1]
    if b > a:
        return mix64(np.atleast_1d((words.hashes[a:b] * multipliers(b - a, 1)).sum(dtype=np.uint64)))
    return grams[:0]
