"""Writing a table in two phases: files first, then a snapshot that names them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import TYPE_CHECKING, Any
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions.rowkind import RowKind
from tablekit.operators.merge import KIND, SEQUENCE, merge_on_read
from tablekit.sources.snapshot import CommitConflict, DataFile, Snapshot, TableSchema
from tablekit.sources.types import arrow_schema

if TYPE_CHECKING:
    from tablekit.catalog import Table

_PART, _BUCKET = "__part_", "__bucket"
#: Columns of these kinds have ranges in the manifests: the primary keys, those of the option stats.columns, or the first few.
_RANGED = (T.IntegralType, T.StringType, T.FloatType, T.DoubleType)
_FIRST_RANGED = 4
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def bucket_of(schema: TableSchema) -> Column:
    """The bucket of a row of a primary-key table, from the keys that aren't partition keys."""
    keys = [F.col(f"`{k}`") for k in schema.primary_keys if k not in schema.partition_keys]
    return F.pmod(F.xxhash64(*keys), F.lit(int(schema.options["bucket"]))).cast("int")


def ranged_columns(schema: TableSchema) -> list[str]:
    fits = [f.name for f in schema.fields if isinstance(f.dataType, _RANGED)]
    named = schema.options.get("stats.columns")
    wanted = [n.strip() for n in named.split(",")] if named else schema.primary_keys or fits[:_FIRST_RANGED]
    return [n for n in wanted if n in fits]


@dataclass(frozen=True)
class CommitMessage:
    """The files of one writer, and the sequence numbers it took."""

    files: tuple[DataFile, ...]
    first_sequence: int = 0
    sequences: int = 0


@dataclass
class BatchWriteBuilder:
    table: Table
    static_partition: dict[str, Any] | None = None
    overwrites: bool = field(default=False)

    def __post_init__(self) -> None:
        if self.table.schema.primary_keys and int(self.table.schema.options.get("bucket", "-1")) < 1:
            raise TypeError("Doesn't support writing dynamic bucket or cross partition table.")

    def overwrite(self, static_partition: Mapping[str, Any] | None = None) -> BatchWriteBuilder:
        """Replaces the whole table, or the given partition; values may be given as strings.

        With the option dynamic-partition-overwrite = true and no partition given,
        just the partitions that are written.
        """
        for k in static_partition or {}:
            if k not in self.table.schema.partition_keys:
                raise ValueError(f"{k} is no partition key of {self.table.schema.partition_keys}.")
        self.static_partition, self.overwrites = dict(static_partition or {}), True
        return self

    def new_write(self) -> BatchTableWrite:
        return BatchTableWrite(self)

    def new_commit(self) -> BatchTableCommit:
        return BatchTableCommit(self)


class BatchTableWrite:
    def __init__(self, builder: BatchWriteBuilder):
        self.builder, self.table = builder, builder.table
        self.first = self.table.snapshots.latest().next_sequence
        self.rows, self.files, self.folders = 0, [], []

    def write_arrow(self, data: pa.Table) -> None:
        expected, given = self.table.schema.fields, data.schema
        table_schema = arrow_schema(expected)
        if [f.type for f in given] != [f.type for f in table_schema]:
            raise ValueError(f"Input schema isn't consistent with table schema.\n\tTable schema is: {list(zip(expected.names, map(str, table_schema.types)))}\n\tInput schema is: {list(zip(given.names, map(str, given.types)))}")
        if not data.num_rows:
            return
        data = data.rename_columns(expected.names)
        if self.table.schema.primary_keys:  # numbered before Spark may deal rows out in another order
            data = data.append_column(SEQUENCE, self._numbers(data.num_rows))
        self.rows += data.num_rows
        self._write(self._typed(self.table.spark.createDataFrame(data)))

    def _numbers(self, rows: int) -> pa.Array:
        return pa.array(np.arange(self.first + self.rows, self.first + self.rows + rows))

    def write_arrow_batch(self, data: pa.RecordBatch) -> None:
        self.write_arrow(pa.Table.from_batches([data]))

    def write_pandas(self, data) -> None:
        self.write_arrow(pa.Table.from_pandas(data, schema=arrow_schema(self.table.schema.fields).remove_metadata(), preserve_index=False))

    def write_dataframe(self, df: DataFrame, sequence_field: str | None = None, kind_field: str | None = None) -> None:
        """Rows of a DataFrame, without the driver; for a primary-key table `sequence_field` orders versions."""
        if not self.table.schema.primary_keys:
            return self._write(self._typed(df))
        if sequence_field is None:
            raise ValueError("A DataFrame's rows have no order: sequence_field must name one for a primary-key table.")
        # above all earlier commits; the field's rank within this one is its own value
        number = F.col(sequence_field).cast("long")
        low, high, rows, numbered = df.agg(F.min(number), F.max(number), F.count("*"), F.count(number)).first()
        if numbered < rows:
            raise ValueError(f"{rows - numbered} rows have no sequence: {sequence_field} is null or no number.")
        if not rows:
            return None
        number = number - F.lit(low) + self.first + self.rows
        self.rows += high - low + 1
        kind = F.col(kind_field).cast("byte") if kind_field else None
        return self._write(self._typed(df.withColumn(SEQUENCE, number), kind))

    def write_changes(self, data: pa.Table, kinds: Sequence[RowKind]) -> None:
        """Arrow rows with a kind each: how rows are deleted."""
        numbers = self._numbers(data.num_rows)
        self.rows += data.num_rows
        rows = data.rename_columns(self.table.schema.fields.names).append_column(SEQUENCE, numbers).append_column(KIND, pa.array([int(k) for k in kinds], pa.int8()))
        self._write(self._typed(self.table.spark.createDataFrame(rows), F.col(KIND)))

    def _typed(self, df: DataFrame, kind=None) -> DataFrame:
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.table.schema.fields]
        if self.table.schema.primary_keys:
            columns += [F.col(SEQUENCE).cast("long").alias(SEQUENCE), (kind if kind is not None else F.lit(0)).cast("byte").alias(KIND)]
        return df.select(*columns)

    def _write(self, df: DataFrame) -> None:
        """Rows of a primary-key table go to one writer for each partition and bucket; those of other
        partitioned tables to as many for each partition as its measured bytes ask for."""
        schema, folder = self.table.schema, uuid.uuid4().hex
        path = f"{self.table.path}/data/{folder}"
        if schema.primary_keys:
            absent = [F.col(f"`{k}`").isNull() for k in schema.primary_keys]
            first = schema.fields[schema.primary_keys[0]]
            df = df.withColumn(first.name, F.when(_any(absent), F.raise_error(F.lit("A primary key is null."))).otherwise(F.col(f"`{first.name}`")).cast(first.dataType))
        names = [_PART + k for k in schema.partition_keys]
        for k, n in zip(schema.partition_keys, names):
            df = df.withColumn(n, F.col(f"`{k}`").cast("string"))
        if schema.primary_keys:
            df = df.withColumn(_BUCKET, bucket_of(schema))
            names.append(_BUCKET)
            df = df.repartition(*(F.col(f"`{n}`") for n in names))
        elif names:
            df = df.hint("rebalance", *names)
        writer = df.write.format(self.table.format)
        self.folders.append(path)
        (writer.partitionBy(*names) if names else writer).save(path)
        written = dict(self.table.store.files(path))
        if not written:
            return
        below = lambda p: p.split(f"/{folder}/", 1)[1]
        ranged = ranged_columns(schema)
        kept = T.StructType([schema.fields[c] for c in ranged] or [schema.fields.fields[0]])
        reader = self.table.spark.read.format(self.table.format).schema(kept).option("recursiveFileLookup", "true").load(path)
        found = reader.groupBy(F.col("_metadata.file_path").alias("__path")).agg(F.count("*"), *(f(F.col(f"`{c}`")) for c in ranged for f in (F.min, F.max))).collect()
        counts = {below(unquote(r[0])): (r[1], {c: (r[2 + 2 * i], r[3 + 2 * i]) for i, c in enumerate(ranged)}) for r in found}
        for p, size in written.items():
            values = {x.split("=", 1)[0]: x.split("=", 1)[1] for x in below(p).split("/")[:-1]}
            bucket = int(values.pop(_BUCKET)) if schema.primary_keys else None
            partition = tuple(None if values[n] == _NO_VALUE else unquote(values[n]) for n in names if n != _BUCKET)
            rows, ranges = counts.get(below(p), (0, {}))
            if rows:
                self.files.append(DataFile(p, rows, size, partition, bucket, ranges))

    def prepare_commit(self) -> list[CommitMessage]:
        message = CommitMessage(tuple(self.files), self.first, self.rows)
        self.files, self.folders = [], []
        return [message]

    def close(self) -> None:
        """Deletes what was written and not handed over for a commit."""
        for path in self.folders:
            self.table.store.delete(path)
        self.folders = []


def _any(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


class BatchTableCommit:
    def __init__(self, builder: BatchWriteBuilder):
        self.builder, self.table = builder, builder.table

    def commit(self, messages: Sequence[CommitMessage], stream: tuple[str, int] | None = None) -> int:
        """Publishes the files as a new snapshot, whose number it returns; tries again if another writer was first.

        stream: a writer and the number of its batch; if a snapshot has that or a later one, nothing is published.
        """
        files = [f for m in messages for f in m.files]
        snapshots, schema = self.table.snapshots, self.table.schema
        added = snapshots.manifest(files) if files else None
        while True:
            last = snapshots.latest()
            if stream and last.streams.get(stream[0], -1) >= stream[1]:
                return last.id
            if schema.primary_keys and any(m.sequences and m.first_sequence < last.next_sequence for m in messages):
                raise CommitConflict("Another writer has committed versions since these were written.")
            kept = snapshots.merged(last) if not self.builder.overwrites else self._kept(snapshots.files(last), files)
            following = max([last.next_sequence, *(m.first_sequence + m.sequences for m in messages)])
            new = Snapshot(last.id + 1, "OVERWRITE" if self.builder.overwrites else "APPEND", [*kept, *([added] if added else [])], following, last.streams | (dict([stream]) if stream else {}))
            if snapshots.publish(new):
                return new.id

    def compact(self, writer: BatchTableWrite) -> int | None:
        """Replaces the live files by few with the same rows; a primary-key table keeps last versions only."""
        from tablekit.plans.read import scan

        snapshots, schema = self.table.snapshots, self.table.schema
        old = snapshots.files(snapshots.latest())
        if not old:
            return None
        df = scan(self.table, old)
        if schema.primary_keys:
            df = merge_on_read(df, schema.primary_keys, schema.options.get("ignore-delete") == "true")
        elif not schema.partition_keys:
            df = df.hint("rebalance")
        writer._write(df)
        files = [f for m in writer.prepare_commit() for f in m.files]
        added = [snapshots.manifest(files)] if files else []
        gone = {f.path for f in old}
        while True:
            last = snapshots.latest()
            live = snapshots.files(last)
            if not gone <= {f.path for f in live}:
                raise CommitConflict("Another writer has replaced files since they were read.")
            later = [f for f in live if f.path not in gone]
            new = Snapshot(last.id + 1, "COMPACT", [*([snapshots.manifest(later)] if later else []), *added], last.next_sequence, last.streams)
            if snapshots.publish(new):
                return new.id

    def _kept(self, live: list[DataFile], new: list[DataFile]) -> list[str]:
        schema, static = self.table.schema, self.builder.static_partition
        if static:
            typed = [F.lit(None if v is None else str(v)).cast(schema.fields[k].dataType).cast("string").alias(k) for k, v in static.items()]
            rows = self.table.spark.createDataFrame([(0,)], "x int").select(*typed).first().asDict()
            where = {schema.partition_keys.index(k): v for k, v in rows.items()}
            for f in new:
                if any(f.partition[i] != v for i, v in where.items()):
                    raise ValueError(f"A row of partition {f.partition} was written into {static}.")
            kept = [f for f in live if any(f.partition[i] != v for i, v in where.items())]
        elif schema.partition_keys and schema.options.get("dynamic-partition-overwrite") == "true":
            gone = {f.partition for f in new}
            kept = [f for f in live if f.partition not in gone]
        else:
            kept = []
        return [self.table.snapshots.manifest(kept)] if kept else []

    def close(self) -> None:
        """Nothing is held open."""
