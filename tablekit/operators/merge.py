"""Merge-on-read of the versions of a primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.functions.rowkind import ADDS, RowKind

SEQUENCE, KIND = "_SEQ", "_KIND"


def latest(versions: DataFrame, keys: Sequence[str], order: Sequence[str] = (SEQUENCE,)) -> DataFrame:
    """The last version of each key.

    A window with row_number, so that Catalyst pushes filters on the keys below
    it, keeps others above, and limits each group before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return versions.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def merge_on_read(versions: DataFrame, keys: Sequence[str], ignore_delete: bool = False, order: Sequence[str] = (SEQUENCE,), kind: str = KIND) -> DataFrame:
    """Deduplicate, then drop the keys whose last version takes the row away."""
    if ignore_delete:
        versions = versions.filter(F.col(kind) != int(RowKind.DELETE))
    return latest(versions, keys, order).filter(F.col(kind).isin(ADDS))
