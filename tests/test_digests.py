"""Digests of copies: what differs is found and mended by reading little."""

import pytest
from pyspark.sql import functions as F

from talkmill.operators import digests


def table(spark, n=20_000):
    return spark.range(n).selectExpr("concat('e', id) as id", "if(id % 7 = 0, null, id) as x", "array(id * 0.5D, null) as v", "repeat('t', 5) as t")


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("laid")
    df = table(spark)
    changed = df.withColumn("x", F.when(F.col("id") == "e77", 5).otherwise(F.col("x"))).where("id != 'e500'").unionByName(df.where("id = 'e9'").withColumn("id", F.lit("more")))
    for name, rows in (("a", df), ("same", df.select("t", "v", "x", "id").orderBy(F.desc("id"))), ("b", changed)):
        digests.lay_out(rows, f"{at}/{name}")
    return at


def test_equal_copies_agree_in_any_order(spark, laid):
    assert digests.differing(spark, f"{laid}/a", f"{laid}/same") == {} and digests.differences(spark, f"{laid}/a", f"{laid}/same").collect() == []
    assert digests.read_ranges(spark, f"{laid}/a", {}).collect() == []


def test_what_differs_is_named_and_little_is_read(spark, laid):
    ranges = digests.differing(spark, f"{laid}/a", f"{laid}/b")
    assert sum(map(len, ranges.values())) == 3
    got = {r["id"]: r["what"] for r in digests.differences(spark, f"{laid}/a", f"{laid}/b").collect()}
    assert got == {"e77": "changed", "e500": "missing", "more": "extra"}
    read = digests.read_ranges(spark, f"{laid}/a", ranges)
    assert read.count() < 20_000 / 64 and "e77" in {r["id"] for r in read.collect()}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "In(range_" in plan


def test_mended_copies_agree(spark, laid):
    assert digests.mend(spark, f"{laid}/a", f"{laid}/b", f"{laid}/c") == 3
    assert digests.differing(spark, f"{laid}/a", f"{laid}/c") == {}
    assert digests.read_ranges(spark, f"{laid}/c").exceptAll(table(spark)).isEmpty() and digests.read_ranges(spark, f"{laid}/c").count() == 20_000


def test_nulls_swapped_values_and_repeated_rows_differ(spark, tmp_path):
    a = spark.createDataFrame([("1", None, "x"), ("2", "x", None), ("3", "y", "z"), ("4", "q", "q")], "id string, a string, b string")
    b = spark.createDataFrame([("1", "x", None), ("2", None, "x"), ("3", "z", "y"), ("4", "q", "q"), ("4", "q", "q")], "id string, a string, b string")
    digests.lay_out(a, f"{tmp_path}/a", buckets=2, ranges=2)
    digests.lay_out(b, f"{tmp_path}/b", buckets=2, ranges=2)
    assert {(r["id"], r["what"]) for r in digests.differences(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect()} == {(i, "changed") for i in "1234"}
