"""Reading a table: what to read is declared, and becomes one DataFrame."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from typing import TYPE_CHECKING, Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions.predicate import Predicate, PredicateBuilder
from tablekit.operators.merge import KIND, SEQUENCE, latest, merge_on_read
from tablekit.plans.write import bucket_of
from tablekit.sources.snapshot import DataFile
from tablekit.sources.types import arrow_schema

if TYPE_CHECKING:
    from tablekit.catalog import Table


class RowType:
    def __init__(self, schema: T.StructType):
        self.schema = schema

    def as_arrow(self) -> pa.Schema:
        return arrow_schema(self.schema)


@dataclass(frozen=True)
class Split:
    """Some files of one partition, of a primary-key table of one bucket, to be read together; it can be pickled and sent elsewhere."""

    files: tuple[DataFile, ...]

    def row_count(self) -> int:
        return sum(f.rows for f in self.files)

    def file_size(self) -> int:
        return sum(f.bytes for f in self.files)

    def file_paths(self) -> list[str]:
        return [f.path for f in self.files]


class Plan:
    def __init__(self, splits: list[Split]):
        self._splits = splits

    def splits(self) -> list[Split]:
        return self._splits


_KINDS = ("+I", "-U", "+U", "-D")
ROW_KIND = "_row_kind"


def scan(table: Table, files: Sequence[DataFile]) -> DataFrame:
    """The rows of some data files, with the columns of versions for a primary-key table.

    Columns that a file lacks are null.  The schema is given, so nothing is inferred from paths.
    """
    spark, schema = table.spark, T.StructType([T.StructField(f.name, f.dataType) for f in table.schema.fields])
    if table.schema.primary_keys:
        schema = schema.add(SEQUENCE, "long").add(KIND, "byte")
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.format(table.format).schema(schema).option("recursiveFileLookup", "true").load([f.path for f in files])


@dataclass(frozen=True)
class ReadBuilder:
    table: Table
    predicate: Predicate | None = None
    projection: tuple[str, ...] | None = None
    limit: int | None = None
    coarse: bool = False
    snapshot_id: int | None = None
    after_id: int | None = None
    row_kinds: bool = False

    def with_filter(self, predicate: Predicate) -> ReadBuilder:
        """Rows that fulfil the predicate; filters given one after the other all hold."""
        both = predicate if self.predicate is None else Predicate("and", parts=(self.predicate, predicate))
        return replace(self, predicate=both)

    def with_projection(self, names: Sequence[str]) -> ReadBuilder:
        for n in names:
            if n not in self.table.schema.fields.names:
                raise ValueError(f"'{n}' is not in list")
        return replace(self, projection=tuple(names))

    def with_limit(self, limit: int, coarse: bool = False) -> ReadBuilder:
        """Exactly `limit` rows; coarse: as many whole splits as hold them."""
        return replace(self, limit=limit, coarse=coarse)

    def at_snapshot(self, snapshot_id: int) -> ReadBuilder:
        return replace(self, snapshot_id=snapshot_id)

    def between_snapshots(self, after: int, upto: int) -> ReadBuilder:
        """What was added after one snapshot and up to another: new rows, or the last of the new versions of each key."""
        return replace(self, after_id=after, snapshot_id=upto)

    def with_row_kind(self) -> ReadBuilder:
        """A further column, the kind of the version each row is of: +I or +U, and from between_snapshots -U and -D too."""
        return replace(self, row_kinds=True)

    def new_predicate_builder(self) -> PredicateBuilder:
        return PredicateBuilder(self.table.schema.fields)

    def read_type(self) -> RowType:
        fields = self.table.schema.fields
        chosen = [*fields] if self.projection is None else [fields[n] for n in self.projection]
        return RowType(T.StructType([*chosen, *([T.StructField(ROW_KIND, T.StringType(), False)] if self.row_kinds else [])]))

    def new_scan(self) -> TableScan:
        return TableScan(self)

    def new_read(self) -> TableRead:
        return TableRead(self)

    def to_df(self) -> DataFrame:
        return self.new_read().to_df(self.new_scan().plan().splits())


#: Whether a file whose values go from least to greatest may have one that the leaf holds for.
_MAY_HOLD: dict[str, Callable[..., bool]] = {
    "equal": lambda lo, hi, x: lo <= x <= hi,
    "less_than": lambda lo, hi, x: lo < x,
    "less_or_equal": lambda lo, hi, x: lo <= x,
    "greater_than": lambda lo, hi, x: hi > x,
    "greater_or_equal": lambda lo, hi, x: hi >= x,
    "between": lambda lo, hi, a, b: lo <= b and hi >= a,
    "is_in": lambda lo, hi, *of: any(lo <= x <= hi for x in of),
}


def _may_hold(p: Predicate, f: DataFile) -> bool:
    low, high = f.ranges.get(p.name, (None, None))
    if low is None or high is None:
        return True
    if isinstance(low, str) and all(isinstance(x, str) for x in p.literals):  # as Spark compares: by bytes
        return _MAY_HOLD[p.method](low.encode(), high.encode(), *(x.encode() for x in p.literals))
    if type(low) is int and all(type(x) is int for x in p.literals):
        return _MAY_HOLD[p.method](low, high, *p.literals)
    return True  # literals become the column's type before they are compared, which may move them


class TableScan:
    def __init__(self, builder: ReadBuilder):
        self.builder = builder

    def plan(self) -> Plan:
        """Live files in splits of one partition each and about source.split.target-size bytes.

        Files are pruned by what the filter says about partition columns, and by the ranges of the columns that have
        them; of a primary-key table by the keys' ranges and buckets alone, as other versions decide on the rest.
        """
        table = self.builder.table
        snapshots = table.snapshots
        chosen = snapshots.latest() if self.builder.snapshot_id is None else snapshots.at(self.builder.snapshot_id)
        files = snapshots.files(chosen)
        if self.builder.after_id:
            known = {f.path for f in snapshots.files(snapshots.at(self.builder.after_id))}
            files = [f for f in files if f.path not in known]
        groups: dict[tuple, list[DataFile]] = {}
        for f in self._in_range(self._in_bucket(self._pruned(files))):
            groups.setdefault((f.partition, f.bucket), []).append(f)
        target, splits = size_of(table.schema.options.get("source.split.target-size", "128mb")), []
        for some in groups.values():
            if table.schema.primary_keys:  # all versions of a key must meet
                splits.append(Split(tuple(some)))
                continue
            held, size = [], 0
            for f in some:
                if held and size + f.bytes > target:
                    splits.append(Split(tuple(held)))
                    held, size = [], 0
                held.append(f)
                size += f.bytes
            splits.append(Split(tuple(held)))
        if self.builder.limit is not None and self.builder.coarse:
            rows = 0
            for k, s in enumerate(splits):
                rows += s.row_count()
                if rows >= self.builder.limit:
                    return Plan(splits[: k + 1])
        return Plan(splits)

    def _in_bucket(self, files: list[DataFile]) -> list[DataFile]:
        """If the filter fixes all of the primary key, only the files of its bucket."""
        schema, predicate = self.builder.table.schema, self.builder.predicate
        keys = [k for k in schema.primary_keys if k not in schema.partition_keys]
        fixed = {p.name: p.literals[0] for p in predicate.conjuncts() if p.method == "equal"} if predicate and keys else {}
        if not keys or any(fixed.get(k) is None for k in keys) or not files:
            return files
        row = self.builder.table.spark.range(1).select(*[F.lit(fixed[k]).cast(schema.fields[k].dataType).alias(k) for k in keys])
        bucket = row.select(bucket_of(schema)).first()[0]
        return [f for f in files if f.bucket is None or f.bucket == bucket]

    def _in_range(self, files: list[DataFile]) -> list[DataFile]:
        schema, predicate = self.builder.table.schema, self.builder.predicate
        able = set(schema.primary_keys or schema.fields.names)
        parts = [p for p in predicate.conjuncts() if p.name in able and p.method in _MAY_HOLD] if predicate else []
        return [f for f in files if all(_may_hold(p, f) for p in parts)]

    def _pruned(self, files: list[DataFile]) -> list[DataFile]:
        table, predicate = self.builder.table, self.builder.predicate
        keys = table.schema.partition_keys
        parts = [p for p in predicate.conjuncts() if p.fields() <= set(keys)] if predicate and keys else []
        if not parts or not files:
            return files
        values = list({f.partition for f in files})
        schema = T.StructType([T.StructField(f"p{i}", T.StringType()) for i in range(len(keys))])
        rows = table.spark.createDataFrame([(*v,) for v in values], schema)
        typed = rows.select("*", *[F.col(f"p{i}").cast(table.schema.fields[k].dataType).alias(k) for i, k in enumerate(keys)])
        for p in parts:
            typed = typed.filter(p.column(table.schema.fields))
        live = {tuple(r) for r in typed.select(*schema.names).collect()}
        return [f for f in files if f.partition in live]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["ipc"])


class TableRead:
    def __init__(self, builder: ReadBuilder):
        self.builder = builder

    def to_df(self, splits: Sequence[Split]) -> DataFrame:
        """Relation, merge of versions, filter, projection and limit, in this order; Catalyst moves them."""
        b, table = self.builder, self.builder.table
        df = scan(table, [f for s in splits for f in s.files])
        if table.schema.primary_keys:
            keys = table.schema.primary_keys
            if b.after_id and b.row_kinds:
                df = latest(df, keys)
            else:
                df = merge_on_read(df, keys, table.schema.options.get("ignore-delete") == "true")
        kind = F.get(F.array(*map(F.lit, _KINDS)), F.col(KIND).cast("int")) if table.schema.primary_keys else F.lit(_KINDS[0])
        kinds = [F.coalesce(kind, F.lit(_KINDS[0])).alias(ROW_KIND)] if b.row_kinds else []
        df = df.select(*[F.col(f"`{n}`") for n in table.schema.fields.names], *kinds)
        if b.predicate is not None:
            df = df.filter(b.predicate.column(table.schema.fields))
        if b.projection is not None:
            df = df.select(*[F.col(f"`{n}`") for n in b.projection], *([ROW_KIND] if b.row_kinds else []))
        return df if b.limit is None or b.coarse else df.limit(b.limit)

    def to_arrow(self, splits: Sequence[Split]) -> pa.Table:
        return self.to_df(splits).toArrow().cast(self.builder.read_type().as_arrow())

    def to_arrow_batch_reader(self, splits: Sequence[Split], batch_rows: int = 1024) -> pa.RecordBatchReader:
        """Batches as they come: executors encode them, and the driver holds a partition at a time.

        With the catalog option max-workers above 1, as many splits are read at once, each whole.
        """
        schema = self.builder.read_type().as_arrow()
        workers = int(self.builder.table.catalog_options.get("max-workers", 1))
        if not schema.names or (workers > 1 and self.builder.limit is None):
            found = self._by_split(splits, workers) if schema.names else iter([self.to_arrow(splits)])
        else:
            packed = self.to_df(splits).mapInArrow(_packed, "ipc binary")
            found = (pa.ipc.open_stream(r[0]).read_all() for r in packed.toLocalIterator(prefetchPartitions=True))
        return pa.RecordBatchReader.from_batches(schema, (b for t in found for b in t.cast(schema).to_batches(batch_rows)))

    def _by_split(self, splits: Sequence[Split], workers: int) -> Iterator[pa.Table]:
        with ThreadPoolExecutor(workers) as pool:
            ahead: deque = deque()
            for s in splits:
                ahead.append(pool.submit(lambda s=s: self.to_df([s]).toArrow()))
                if len(ahead) == workers:
                    yield ahead.popleft().result()
            while ahead:
                yield ahead.popleft().result()

    def to_pandas(self, splits: Sequence[Split]):
        return self.to_df(splits).toPandas()

    def to_iterator(self, splits: Sequence[Split]) -> Iterator[tuple]:
        return map(tuple, self.to_df(splits).toLocalIterator())

    def to_view(self, splits: Sequence[Split], name: str) -> DataFrame:
        """Registers the result for spark.sql."""
        df = self.to_df(splits)
        df.createOrReplaceTempView(name)
        return df

    def to_duckdb(self, splits: Sequence[Split], name: str, connection: Any = None):
        import duckdb

        connection = connection or duckdb.connect(":memory:")
        connection.register(name, self.to_arrow(splits))
        return connection

    def to_ray(self, splits: Sequence[Split]):
        import ray

        return ray.data.from_arrow(self.to_arrow(splits))


def size_of(text: str) -> int:
    """Bytes of sizes like 64mb."""
    number = "".join(c for c in text if c.isdigit())
    unit = text[len(number) :].strip().lower() or "b"
    return int(number) * {"b": 1, "kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}[unit]
