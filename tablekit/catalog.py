"""Catalogs of databases and tables below a warehouse path."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablekit.plans.read import ReadBuilder
from tablekit.plans.write import BatchWriteBuilder
from tablekit.sources.snapshot import Schemas, Snapshots, TableSchema
from tablekit.sources.store import Store
from tablekit.sources.types import spark_schema


@dataclass
class Schema:
    """What create_table takes: an Arrow schema, or a StructType of any types."""

    fields: pa.Schema | T.StructType
    partition_keys: Sequence[str] | None = None
    primary_keys: Sequence[str] | None = None
    options: Mapping[str, str] | None = None
    comment: str | None = None


@dataclass
class Table:
    spark: SparkSession
    path: str
    schema: TableSchema
    catalog_options: Mapping[str, str] = field(default_factory=dict)

    @property
    def store(self) -> Store:
        return Store()

    @property
    def snapshots(self) -> Snapshots:
        return Snapshots(self.store, self.path)

    @property
    def format(self) -> str:
        return self.schema.options.get("file.format", "parquet")

    def new_read_builder(self) -> ReadBuilder:
        return ReadBuilder(self)

    def new_batch_write_builder(self) -> BatchWriteBuilder:
        return BatchWriteBuilder(self)

    def add_column(self, name: str, kind: T.DataType | str) -> None:
        """A new, nullable column, in a new version of the schema; rows written before have null there."""
        schemas = Schemas(self.store, self.path)
        while True:
            version, found = schemas.latest()
            if name in found.fields.names:
                raise ValueError(f"The field {name} is in field list {found.fields.names} already.")
            found.fields = T.StructType([*found.fields.fields, T.StructField(name, T.DataType.fromDDL(kind) if isinstance(kind, str) else kind)])
            if schemas.publish(version + 1, found):
                self.schema = found
                return

    def compact(self) -> int | None:
        """Rewrites the live files into few: of a primary-key table just the last versions.  The new snapshot's number, or None if there is nothing."""
        builder = self.new_batch_write_builder()
        return builder.new_commit().compact(builder.new_write())

    def expire_snapshots(self, keep: int) -> int:
        """Deletes all but the last `keep` snapshots and what only they name; how many they were."""
        return self.snapshots.expire(keep)

    def to_df(self) -> DataFrame:
        return self.new_read_builder().to_df()

    def as_view(self, name: str) -> DataFrame:
        df = self.to_df()
        df.createOrReplaceTempView(name)
        return df


def has_format(spark: SparkSession, kind: str) -> bool:
    try:
        spark.read.format(kind).schema("x int").load([])
        return True
    except AnalysisException as e:
        return "DATA_SOURCE" not in (e.getCondition() or "") and "data source" not in str(e)


def _identifier(name: str) -> tuple[str, str]:
    parts = name.split(".")
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"{name!r} is not of the form database.table.")
    return parts[0], parts[1]


class Catalog:
    def __init__(self, spark: SparkSession, options: Mapping[str, str]):
        if "warehouse" not in options:
            raise ValueError("The option 'warehouse' is missing.")
        workers = options.get("max-workers")
        if workers is not None and int(workers) <= 0:
            raise ValueError(f"max-workers must be greater than 0, not {workers}.")
        self.spark, self.options, self.warehouse = spark, dict(options), options["warehouse"].rstrip("/")
        self.store = Store()

    @staticmethod
    def create(options: Mapping[str, str], spark: SparkSession | None = None) -> Catalog:
        return Catalog(spark or SparkSession.builder.getOrCreate(), options)

    def _database(self, name: str) -> str:
        return f"{self.warehouse}/{name}.db"

    def create_database(self, name: str, ignore_if_exists: bool, properties: Mapping[str, str] | None = None) -> None:
        path = self._database(name)
        if self.store.exists(path):
            if not ignore_if_exists:
                raise ValueError(f"The database {name} exists already.")
            return
        self.store.make(path)
        self.store.create(f"{path}/database.json", json.dumps(dict(properties or {})))

    def database_properties(self, name: str) -> dict[str, str]:
        path = self._database(name)
        if not self.store.exists(path):
            raise ValueError(f"The database {name} does not exist.")
        return json.loads(self.store.read(f"{path}/database.json")) if self.store.exists(f"{path}/database.json") else {}

    def create_table(self, identifier: str, schema: Schema, ignore_if_exists: bool) -> None:
        database, name = _identifier(identifier)
        if not self.store.exists(self._database(database)):
            raise ValueError(f"The database {database} does not exist.")
        path = f"{self._database(database)}/{name}"
        fields = spark_schema(schema.fields)
        partition, primary = list(schema.partition_keys or []), list(schema.primary_keys or [])
        for k in [*partition, *primary]:
            if k not in fields.names:
                raise ValueError(f"The key {k} is not in field list {fields.names}.")
        if primary and not set(primary) - set(partition):
            raise ValueError(f"The primary key {primary} must have more than the partition keys {partition}.")
        if primary and not set(partition) <= set(primary):
            raise ValueError(f"The primary key {primary} must include the partition keys {partition}.")
        kind = (schema.options or {}).get("file.format", "parquet")
        if kind not in ("parquet", "orc", "avro"):
            raise ValueError(f"Unknown file format {kind}.")
        if kind == "avro" and not has_format(self.spark, kind):
            raise ValueError("The format avro needs Spark's Avro module, which this session doesn't have.")
        found = TableSchema(T.StructType([T.StructField(f.name, f.dataType, f.nullable and f.name not in primary) for f in fields]), partition, primary, dict(schema.options or {}), schema.comment)
        self.store.make(path)
        if not Schemas(self.store, path).publish(0, found) and not ignore_if_exists:
            raise ValueError(f"The table {identifier} exists already.")

    def get_table(self, identifier: str) -> Table:
        database, name = _identifier(identifier)
        path = f"{self._database(database)}/{name}"
        found = Schemas(self.store, path).latest()
        if found is None:
            raise ValueError(f"The table {identifier} does not exist.")
        return Table(self.spark, path, found[1], self.options)
