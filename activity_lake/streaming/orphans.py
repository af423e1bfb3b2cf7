"""Rows of a stream whose parent, arriving in another stream, has not come and can no longer come.

An outer join of two streams with watermarks: a row waits in the state until its parent arrives, before or after it, or until
the watermark of both streams has passed the last time that a parent may have. Only then is it an orphan. State of both sides
is dropped with the watermark, so it is bounded by ``within`` and the delay, not by the length of the streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_orphans(
    rows: DataFrame, parents: DataFrame, key: str, parent_key: str, time: str, parent_time: str, before: str, after: str, delay: str,
) -> DataFrame:
    """Rows without a parent of their key between ``before`` and ``after`` their own time; all are SQL intervals.

    ``delay`` is how late either stream may be. Rows without a key have no parent to miss and are left out. The streams go on
    only when both do: a stream without news holds the watermark back, so an idle one needs a heartbeat now and then, a row with a
    key that nobody has. (Rows without a key are filtered before they can move the watermark.)
    """
    child = rows.withWatermark(time, delay).alias("row")
    parent = parents.select(F.col(parent_key).alias("_parent"), F.col(parent_time).alias("_parent_time")).withWatermark("_parent_time", delay)
    near = F.expr(f"_parent_time >= row.{time} - INTERVAL {before} AND _parent_time <= row.{time} + INTERVAL {after}")
    joined = child.join(parent, (F.col(f"row.{key}") == F.col("_parent")) & near, "left_outer")
    return joined.filter(F.col("_parent").isNull() & F.col(f"row.{key}").isNotNull()).select("row.*")
