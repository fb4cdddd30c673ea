"""Counts of classifications."""

from pyspark.sql import functions as F

from talkmill.operators import migrate


def test_no_task_ranks_a_classification(spark):
    rows = spark.range(0, 2000, 1, 4).select(F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("id"), (F.col("id") % 2).cast("string").alias("classification"))
    out = migrate.classification_counts(rows, 3)
    assert {(r["classification"], r["records"], *r["sample"]) for r in out.collect()} == {("0", 1000, "r0000", "r0002", "r0004"), ("1", 1000, "r0001", "r0003", "r0005")}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
