"""Sessions and tables that the driver shares with its executors."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
#: Settings that the engine counts on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(app: str = "talkmill", **more: str) -> SparkSession:
    """A session with the engine's settings; master and sizes come from spark-submit or `more`."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return prepared(builder.getOrCreate())


def prepared(spark: SparkSession) -> SparkSession:
    """Lets Python workers of a session that someone else made import this package."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, of the session or set on its context. Only where all runs on one machine, as in tests, may it be unset, for a temporary folder then; on a cluster that raises."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            at = kept.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            at = tempfile.mkdtemp(prefix="talkmill-")
            spark.sparkContext.setCheckpointDir(at)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, read back by column, and safe from lost executors."""
    at = f"{shared_dir(df.sparkSession)}/talkmill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    back = df.sparkSession.read.schema(df.schema).parquet(at)
    back._talkmill_at = at
    return back


def drop_written(df: DataFrame) -> None:
    """Deletes a table of written() that nothing reads any more."""
    spark, at = df.sparkSession, df._talkmill_at
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_written(spark: SparkSession, older_s: float = 2 * 24 * 3600) -> int:
    """Deletes what jobs have left in the library's part of the shared folder over older_s seconds ago: tables that cut lineage, and stores, feeds and files of queries. Results are read from them, so that a job can't delete its last ones itself. Returns how many folders went."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/talkmill")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [x for x in (files.listStatus(path) if files.exists(path) else []) if time.time() - x.getModificationTime() / 1000 > older_s]
    for x in old:
        files.delete(x.getPath(), True)
    return len(old)
