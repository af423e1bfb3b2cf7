"""Delivery of messages with a claim log: one message per event, also when a sender dies midway.

    claims/batch=<n>/        the messages of a batch, keyed by partition and offset, dealt to waves
    outcomes/batch=<n>/wave=<w>/   what became of the messages of a wave: sent or failed, with the code

A batch claims its messages first: that is written, so that a retry finds the same messages in the same waves. Then it sends
wave by wave, and writes the outcomes of one before it starts the next. If a sender dies, the outcomes of a single wave are
in doubt. Before anything is sent again these are settled: the service is asked which of them it has had, by their keys, and
only the others are sent. A message has an outcome once, and is handed to the service once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.operators.notify import let_go
from activity_lake.sinks.hadoop import HadoopFiles

KEY = ("kafka_partition", "kafka_offset")
_CLAIM = "kafka_partition INT, kafka_offset BIGINT, employe_id BIGINT, message_text STRING, wave INT"
_OUTCOME = "kafka_partition INT, kafka_offset BIGINT, employe_id BIGINT, message_text STRING, status STRING, status_code INT"

# keys and texts of some messages -> HTTP-like codes
Send = Callable[[pd.DataFrame], pd.Series]
# keys of some messages -> the codes that the service has answered with, NaN for messages it has not had
Settle = Callable[[pd.DataFrame], pd.Series]


class Delivery:
    """Handler of micro-batches of messages (kafka_partition, kafka_offset, employe_id, message_text).

    ``wave_rows`` bounds what can be in doubt; ``parallel_calls`` tasks send a wave. Both functions run in these tasks.
    """

    def __init__(self, spark: SparkSession, root: str, send: Send, settle: Settle, wave_rows: int = 10_000, parallel_calls: int = 8):
        self._spark = spark
        self._root = root
        self._files = HadoopFiles(spark, root)
        self._send = send
        self._settle = settle
        self._wave_rows = wave_rows
        self._calls = parallel_calls

    def _claims(self, batch_id: int) -> str:
        return f"{self._root}/claims/batch={batch_id}"

    def _outcomes(self, batch_id: int, wave: int) -> str:
        return f"{self._root}/outcomes/batch={batch_id}/wave={wave}"

    def _is_written(self, path: str) -> bool:
        return self._files.exists(f"{path}/_SUCCESS")

    def __call__(self, texts: DataFrame, batch_id: int) -> None:
        """Claim and deliver a batch; called again after a failure it goes on where the last attempt stopped."""
        claims = self._claims(batch_id)
        if not self._is_written(claims):
            once = texts.dropDuplicates(list(KEY)).select(*KEY, "employe_id", "message_text").persist()
            try:
                waves = max(-(-once.count() // self._wave_rows), 1)
                dealt = once.withColumn("wave", F.pmod(F.xxhash64(*KEY), F.lit(waves)).cast("int"))
                part = F.pmod(F.xxhash64("kafka_offset", F.lit("part")), F.lit(self._calls))
                self._new(dealt, batch_id).repartition("wave", part).write.mode("overwrite").partitionBy("wave").parquet(claims)
            finally:
                once.unpersist()
        claimed = self._spark.read.schema(_CLAIM).parquet(claims)
        known = {int(name.removeprefix("wave=")) for name in self._files.names(claims) if name.startswith("wave=")}
        for wave in sorted(known):
            if not self._is_written(self._outcomes(batch_id, wave)):
                self._deliver(claimed.filter(F.col("wave") == wave), batch_id, wave)

    def _new(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Without what an earlier batch has claimed: a topic may deliver an event again."""
        names = [name for name in self._files.names(f"{self._root}/claims") if name != f"batch={batch_id}"]
        earlier = [f"{self._root}/claims/{name}" for name in names if self._is_written(f"{self._root}/claims/{name}")]
        if not earlier:
            return rows
        return rows.join(self._spark.read.schema(_CLAIM).parquet(*earlier).select(*KEY), list(KEY), "left_anti")

    def _deliver(self, rows: DataFrame, batch_id: int, wave: int) -> None:
        """Settle what an earlier attempt may have sent, then send the rest, and write the outcomes.

        The mark of an attempt is set before it sends; a wave without one has never been started. The claims are read and sent
        in one stage without a shuffle, so a message is only ever repeated by another attempt of its task, which settles
        too. Speculative execution, which runs two attempts at a time, must be off for this.
        """
        mark = f"{self._root}/started/batch={batch_id}-wave={wave}"
        in_doubt = not self._files.create_text(mark, "")
        send, settle = self._send, self._settle

        def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            again = in_doubt or TaskContext.get().attemptNumber() > 0
            for batch in batches:
                codes = np.full(len(batch), np.nan)
                if again:
                    codes = pd.Series(settle(batch[list(KEY)]), dtype="float64").to_numpy().copy()
                rest = np.isnan(codes)
                if rest.any():
                    codes[rest] = pd.Series(send(batch[rest].reset_index(drop=True)), dtype="float64").to_numpy()
                let_go()
                yield batch.drop(columns="wave").assign(
                    status=np.where(codes == 200, "sent", "failed"), status_code=codes.astype("int32"))

        rows.select(*KEY, "employe_id", "message_text", "wave").mapInPandas(post, _OUTCOME).write.mode("overwrite").parquet(self._outcomes(batch_id, wave))

    def outbox(self) -> DataFrame:
        """One row per delivered message, of all complete waves."""
        top = f"{self._root}/outcomes"
        paths = [f"{top}/{batch}/{wave}" for batch in self._files.names(top) for wave in self._files.names(f"{top}/{batch}")]
        done = [path for path in paths if self._is_written(path)]
        return self._spark.read.schema(_OUTCOME).parquet(*done) if done else self._spark.createDataFrame([], _OUTCOME)
