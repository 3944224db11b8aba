"""Aggregates over event time, and states, on streams and tables alike; streams forget what their watermark has passed."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(rows: DataFrame, time: str, size: str, by: Sequence[str], aggregates: Sequence[Column], slide: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """by, window_start, window_end and the aggregates of tumbling windows, or of sliding ones if `slide` is given.

    Rows later than `delay` behind the latest one may be left out, as their window has been closed.
    """
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return _spread(_marked(rows, time, delay).groupBy(*by, window.alias("__w")).agg(*aggregates))


def sessions(rows: DataFrame, time: str, gap: str, by: Sequence[str], aggregates: Sequence[Column], delay: str = "0 seconds") -> DataFrame:
    """by, window_start, window_end and the aggregates of sessions: rows of one key less than `gap` apart; a session ends a gap after its last row."""
    return _spread(_marked(rows, time, delay).groupBy(*by, F.session_window(time, gap).alias("__w")).agg(*aggregates))


def distinct_within(rows: DataFrame, time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """The first row of each key among those that come within `delay`."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys)) if rows.isStreaming else rows.dropDuplicates(list(keys))


def running_totals(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, n and total over all rows seen so far, of every key that a batch touches; for streams."""

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, value).groupBy(key).applyInPandasWithState(update, f"{key} {kind}, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def _marked(rows: DataFrame, time: str, delay: str) -> DataFrame:
    return rows.withWatermark(time, delay) if rows.isStreaming else rows


def _spread(found: DataFrame) -> DataFrame:
    others = [c for c in found.columns if c != "__w"]
    return found.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *others)


def drained(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """What a stream gives once all of its source is read: of mode append and update all rows, of complete the last result."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out" if mode == "complete" else f"{folder}/out/batch={number}")

    stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/out")
