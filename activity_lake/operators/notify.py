"""One message per activity event, and an outbox that records what became of it."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.functions.formatting import format_day, format_duration, format_km, message_text
from activity_lake.operators.joins import with_person_name

# message texts -> HTTP-like status codes
Sender = Callable[[pd.Series], pd.Series]

_OUTBOX = "kafka_partition INT, kafka_offset BIGINT, employe_id BIGINT, message_text STRING, status STRING, status_code INT"


def notifiable(parsed: DataFrame, include_deleted: bool = False) -> DataFrame:
    """Events that are valid JSON. Deletes are left out unless asked for."""
    events = parsed.filter(F.col("id_evenement_sportif").isNotNull())
    return events if include_deleted else events.filter(F.coalesce("__deleted", F.lit("false")) != "true")


def messages(parsed: DataFrame, people: DataFrame, include_deleted: bool = False, signed: bool = True) -> DataFrame:
    """Parsed change events with the text to send."""
    named = with_person_name(notifiable(parsed, include_deleted), people)
    text = message_text(
        F.col("nom_complet"),
        F.col("type_pratique_sportive"),
        format_day(F.coalesce("date", F.lit("0"))),
        format_km(F.col("distance.value"), F.col("distance.scale"), signed),
        format_duration(F.coalesce("temps_ecoule", F.lit(0))),
        F.col("commentaire"),
    )
    return named.select("kafka_partition", "kafka_offset", "employe_id", text.alias("message_text"))


def queued(texts: DataFrame) -> DataFrame:
    """Outbox rows for a sender outside this engine."""
    return texts.withColumn("status", F.lit("queued")).withColumn("status_code", F.lit(None).cast("int"))


def let_go() -> None:
    """Free what a sender has been handed, where no variable holds it any longer.

    pandas' ``.str`` makes a cycle of a column and its accessor, which only Python's collector frees. That runs after so many
    new objects; a batch is few objects of many texts, so hundreds of batches would pile up before it does.
    """
    gc.collect(1)


def deliver(texts: DataFrame, send: Sender) -> DataFrame:
    """Outbox rows after sending: ``sent`` for code 200, else ``failed``, with the code. A retried task sends again."""

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # A copy without the data: the batch holds its own columns until it has been written.
            codes = pd.Series(send(batch["message_text"].copy(deep=False))).to_numpy()
            let_go()
            yield batch.assign(status=np.where(codes == 200, "sent", "failed"), status_code=codes.astype("int32"))

    return texts.mapInPandas(post, _OUTBOX)
