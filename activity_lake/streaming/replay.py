"""Events that a topic delivers again: each position counts once, also across a restart.

The state that knows which positions have been seen is bounded by event time. Positions are remembered until the watermark,
the newest broker time less ``within``, has passed them by ``within``. What is older than the watermark when it arrives is
a replay too, unless a producer is later than ``within``: then it is dropped, so ``within`` is to be chosen longer than
producers are ever late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

POSITION = ("kafka_partition", "kafka_offset")


def once_per_position(rows: DataFrame, within: str, time: str = "kafka_ts") -> DataFrame:
    """A stream without the rows whose position it has had before. State is keyed by partition and offset."""
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(list(POSITION))
