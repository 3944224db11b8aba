"""Functions of users, in Arrow batches: of values, of groups, and from rows to tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.LongType())
def digit_sum(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The sum of the decimal digits of whole numbers, whatever their sign; null for null."""
    for v in values:
        total, rest = pd.Series(0, v.index, "Int64"), v.astype("Int64").abs()
        while (rest.fillna(0) > 0).any():
            total, rest = total + rest % 10, rest // 10
        yield total


@F.pandas_udf(T.DoubleType())
def middle(values: pd.Series) -> float:
    """The median of a group; null without values."""
    return float(values.median()) if values.notna().any() else None


@F.udtf(returnType=T.StructType([T.StructField("part", T.IntegerType()), T.StructField("word", T.StringType())]))
class Words:
    """The words of a text between single spaces, numbered from 0; none for null."""

    def eval(self, text: str):
        for i, w in enumerate((text or "").split(" ")):
            if w:
                yield i, w
