"""An embedding pass as a stream: each planned crop is taken once, whatever is sent again and wherever a run breaks off."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.planning import completed_episodes, dedupe_records
from ..session import prepared

#: What makes a crop one; attempt tells how often it was planned anew.
CROP = ("episode", "cluster", "draw", "length_s", "attempt")
#: How long a crop is remembered after the plan that asked for it, in time of the plans' files.
REMEMBERED = "30 days"


def send_plan(plan: DataFrame, folder: str, attempt: int = 0) -> None:
    """Puts a plan's rows where embed_stream() finds them. Rows that were sent before do no harm."""
    plan.withColumn("attempt", F.lit(attempt)).write.mode("append").json(folder)


def embed_stream(spark: SparkSession, plans: str, log: str, checkpoint: str, schema: StructType | str, embed: Callable[[DataFrame], DataFrame], *, remembered: str = REMEMBERED) -> int:
    """Takes what was sent to the folder plans since the last call, and stops: crops that no earlier run took go through embed (rows to rows with vector, error and error_kind) and are added to the log. Returns how many batches ran.

    What was taken is held in the stream's state, in the checkpoint, not read from the log: a batch meets its own keys alone. State is dropped for crops whose plan is older than `remembered`. A batch writes a part of the log of its own number, over what a broken run left of it; so each crop is in the log once.
    """
    prepared(spark)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).json(plans)
    rows = rows.withColumn("sent_at", F.col("_metadata.file_modification_time")).withWatermark("sent_at", remembered)
    once = rows.dropDuplicatesWithinWatermark(list(CROP))
    ran = []

    def take(batch: DataFrame, number: int) -> None:
        embed(batch.drop("sent_at")).withColumn("seq", F.lit(number)).write.mode("overwrite").json(f"{log}/batch={number:09d}")
        ran.append(number)

    query = once.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(ran)


def read_log(spark: SparkSession, log: str, schema: StructType | str) -> DataFrame:
    """All that runs have written: schema and seq, the batch. Batches that broke off have no part yet."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(StructType([*fields.fields, *StructType.fromDDL("seq long").fields])).json(log).drop("batch")


def unfinished(log: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of a plan whose episodes aren't whole in the log: too few crops, or one whose audio couldn't be fetched. To be sent again, as the next attempt; the later record of a crop counts."""
    return plan.join(completed_episodes(log, plan).select("episode"), "episode", "left_anti")


def latest(log: DataFrame) -> DataFrame:
    """The last record of each crop, of whatever attempt."""
    return dedupe_records(log.withColumn("seq", F.struct("attempt", "seq"))).drop("first_seq").withColumn("seq", F.col("seq.seq"))
