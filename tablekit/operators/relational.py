"""Joins Spark has no operator for, on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A range goes into no more bins than about this many, as grids grow coarser by this factor.
MOST_BINS = 64


def _known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns])


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, columns: Sequence[str], bucket: Column | None = None) -> DataFrame:
    """left with `columns` of the last right row of the same `by` at or before left's time, null if there is none.

    Null keys and times match nothing.  Of right rows of one time, any may be the last.  Both sides go through
    one shuffle; the last known values are carried on by a window.  With `bucket`, an expression of `__t`
    that never falls as time goes on, a key's rows are dealt by it too, so that a hot key needs no single task;
    the last value of each bucket is carried to those after it through one row a bucket.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    named = lambda t: [*[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)], F.col(f"`{t}`").alias("__t")]
    values = F.struct(*[F.col(f"`{c}`").alias(c) for c in columns])
    r_rows = right.filter(_known([*by, right_time])).select(*named(right_time), F.lit(0).alias("__side"), values.alias("__v"))
    l_rows = left.select(*named(left_time), F.lit(1).alias("__side"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__row"))
    known = _known([*keys, "__t"])
    met = l_rows.filter(known).unionByName(r_rows, allowMissingColumns=True)
    deal = list(keys)
    if bucket is not None:
        met = met.withColumn("__b", bucket)
        deal.append("__b")
    upto = Window.partitionBy(*deal).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("__v", ignorenulls=True).over(upto)
    if bucket is not None:
        ends = r_rows.withColumn("__b", bucket).groupBy(*deal).agg(F.max_by("__v", "__t").alias("__end"))
        every = met.select(*deal).distinct().join(ends, deal, "left")
        before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        carried = every.withColumn("__carried", F.last("__end", ignorenulls=True).over(before)).drop("__end")
        met = met.withColumn("__last", last).join(carried, deal, "left").withColumn("__last", F.coalesce("__last", "__carried"))
    else:
        met = met.withColumn("__last", last)
    found = met.filter("__side = 1").select("__row", "__last")
    found = found.unionByName(l_rows.filter(~known).select("__row"), allowMissingColumns=True)
    return found.select("__row.*", *[F.col(f"__last.`{c}`").alias(c) for c in columns])


def range_join(left: DataFrame, right: DataFrame, point: str, low: str, high: str, width: float | None = None) -> DataFrame:
    """Pairs with low <= point < high: ranges are cut into bins, so that it is an equi-join.

    Bins are `width` wide, or as wide as the mean range.  A range over more than MOST_BINS bins goes into bins of
    a coarser grid, MOST_BINS times as wide a level, so that no range is multiplied more than that.  Nulls match nothing.
    """
    right = right.filter(_known([low, high]) & (F.col(low) < F.col(high)))
    if width is None:
        width = right.agg(F.avg((F.col(high) - F.col(low)).cast("double"))).first()[0] or 1.0
    span = (F.col(high) - F.col(low)).cast("double") / width
    level = F.greatest(F.lit(0), F.ceil(F.log(float(MOST_BINS), F.greatest(span, F.lit(1.0))) - 1)).cast("int")
    levels = right.select(F.max(level)).first()[0]
    at = lambda c, n: F.floor(F.col(c) / (F.lit(width) * F.pow(F.lit(float(MOST_BINS)), n)))
    bins = right.withColumn("__level", level).withColumn("__bin", F.explode(F.sequence(at(low, F.col("__level")), at(high, F.col("__level")))))
    points = left.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(levels or 0)))).withColumn("__bin", at(point, F.col("__level")))
    return points.join(bins, ["__level", "__bin"]).filter((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop("__level", "__bin")


def interval_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, before: str, after: str) -> DataFrame:
    """Pairs of one key whose right time is from `before` before to `after` after the left one, both included; SQL intervals of days and shorter units.

    Times are cut into slots as long as the whole window, so that a hot key is dealt over its slots and a left
    row goes to two of them at most.
    """
    day = "TIMESTAMP'2000-01-01 00:00:00'"
    span = left.sparkSession.range(1).select(F.expr(f"unix_micros({day} + INTERVAL {after}) - unix_micros({day} - INTERVAL {before})")).first()[0]
    slot = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(max(span, 1)))
    ends = F.array(slot(F.col(left_time) - F.expr(f"INTERVAL {before}")), slot(F.col(left_time) + F.expr(f"INTERVAL {after}")))
    lows = left.withColumn("__slot", F.explode(F.array_distinct(ends)))
    highs = right.withColumn("__slot", slot(F.col(right_time)))
    near = (F.col(right_time) >= F.col(left_time) - F.expr(f"INTERVAL {before}")) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {after}"))
    return lows.join(highs, [*by, "__slot"]).filter(near).drop("__slot")
