"""Arrow types of table schemas and what they are in Spark."""

from __future__ import annotations

import warnings

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_PLAIN = {pa.int8(): T.ByteType(), pa.int16(): T.ShortType(), pa.int32(): T.IntegerType(), pa.int64(): T.LongType(), pa.float16(): T.FloatType(), pa.float32(): T.FloatType(), pa.float64(): T.DoubleType(), pa.string(): T.StringType(), pa.bool_(): T.BooleanType()}


def spark_type(name: str, kind: pa.DataType) -> T.DataType:
    if pa.types.is_null(kind):
        warnings.warn(f"The field {name} is of type null and becomes a string.", stacklevel=2)
        return T.StringType()
    if kind not in _PLAIN:
        raise ValueError(f"Found unsupported data type {kind} for field {name}.")
    return _PLAIN[kind]


def spark_schema(schema: pa.Schema | T.StructType) -> T.StructType:
    """Of an Arrow schema by the table above; a StructType stays, of any types."""
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType([T.StructField(f.name, spark_type(f.name, f.type), f.nullable) for f in schema])


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType), f.nullable) for f in schema])
