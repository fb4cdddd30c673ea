"""Ingest of transcripts as they come, with what batch uses: parse, chunk, encode, replace."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_triple, segments, title_of
from ..operators.chunking import chunk_metadata, fold_chunks
from ..sources.readers import with_model
from ..sources.store import Collection, upsert_then_prune

RULES_VERSION = "1"


def records_of(texts: DataFrame, encode: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Records of transcripts (name, text): all chunks with their metadata and vectors. Names that aren't transcripts' are passed over. Of a name that comes twice the last version counts (columns name, text, at)."""
    last = texts.groupBy("name").agg(F.max_by("text", "at").alias("text"))
    df = last.withColumn("k", file_triple(F.col("name"))).where("k is not null").select("k.*", title_of(F.col("text")).alias("episode_title"), "text")
    keys = ("show", "episode_number", "date", "episode_title")
    chunks = chunk_metadata(fold_chunks(segments(df), keys), RULES_VERSION)
    none = F.lit(None).cast("string")
    out = chunks.withColumnRenamed("text", "document").withColumns({"episode_guid": none, "speaker_id": none, "identity_version": none, "source": none})
    return with_model(out, encode, "document", "embedding")


def ingest_available(spark: SparkSession, folder: str, collection: Collection, encode: Callable[[pd.Series], pd.Series], checkpoint: str) -> int:
    """Takes in all transcripts that came since the last call, and stops. Each batch replaces its episodes; run again after a crash, it gives the same records, since ids and snapshots depend on the texts alone. Returns how many batches ran."""
    stream = spark.readStream.schema("value string").option("wholetext", "true").option("pathGlobFilter", "*.txt").format("text").load(folder)
    texts = stream.select(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("name"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("at"))
    done = []

    def take(batch: DataFrame, number: int) -> None:
        upsert_then_prune(collection, records_of(batch, encode))
        done.append(number)

    query = texts.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)
