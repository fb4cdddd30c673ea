"""Copies held against each other by digests: of ranges, of buckets, of all. What differs is read; what agrees is not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_written, written

#: Buckets of a laid-out table and ranges in each: so many digests there are, whatever the table.
BUCKETS, RANGES = 64, 64


def _place(id_col: str, buckets: int, ranges: int) -> tuple[Column, Column]:
    h = F.xxhash64(F.col(id_col).cast("string"))
    return F.pmod(h, F.lit(buckets)).cast("int"), F.pmod(F.floor(h / buckets), F.lit(ranges)).cast("int")


def _row_digest(columns: list[str]) -> Column:
    """64 bits of a row's values; names of columns count, their order doesn't. Nulls differ from all values, and from nulls elsewhere."""
    parts = [x for c in sorted(columns) for x in (F.lit(c), F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*parts)


def lay_out(records: DataFrame, at: str, *, id_col: str = "id", buckets: int = BUCKETS, ranges: int = RANGES) -> None:
    """Writes records to at/rows, by buckets and in each by ranges of a hash of the id, and to at/leaves one digest for each range: n, and sums of the rows' digests that don't depend on their order. Files are sorted by range, so that a reader of one skips the rest by the bounds of row groups and pages."""
    bucket, range_ = _place(id_col, buckets, ranges)
    laid = records.withColumns({"bucket_": bucket, "range_": range_})
    laid.hint("rebalance", "bucket_").sortWithinPartitions("bucket_", "range_", id_col).write.partitionBy("bucket_").parquet(f"{at}/rows")
    spark = records.sparkSession
    stored = spark.read.schema(laid.schema).parquet(f"{at}/rows")
    _leaves(stored, records.columns).coalesce(1).write.parquet(f"{at}/leaves")


def _leaves(laid: DataFrame, columns: list[str]) -> DataFrame:
    d = _row_digest(columns)
    return laid.groupBy("bucket_", "range_").agg(F.count("*").alias("n"), F.bit_xor(d).alias("x"), F.sum(F.pmod(d, F.lit((1 << 31) - 1))).alias("s"))


def leaves(spark: SparkSession, at: str) -> DataFrame:
    return spark.read.schema("bucket_ int, range_ int, n long, x long, s long").parquet(f"{at}/leaves")


def differing(spark: SparkSession, a: str, b: str) -> dict[int, list[int]]:
    """The ranges, by bucket, whose digests differ between two tables that are laid out alike. Buckets are compared first: where those agree, their ranges do."""
    whole = lambda df: df.groupBy("bucket_").agg(F.sum("n").alias("n"), F.bit_xor(F.xxhash64("range_", "n", "x", "s")).alias("x"))

    def apart(x: DataFrame, y: DataFrame, keys: list[str]) -> DataFrame:
        rest = [c for c in x.columns if c not in keys]
        both = x.join(y.withColumnsRenamed({c: f"{c}_b" for c in rest}), keys, "full")
        same = [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in rest]
        return both.where(~_all(same)).select(*keys)

    left, right = leaves(spark, a), leaves(spark, b)
    buckets = apart(whole(left), whole(right), ["bucket_"])
    found: dict[int, list[int]] = {}
    for r in apart(left.join(buckets, "bucket_", "left_semi"), right.join(buckets, "bucket_", "left_semi"), ["bucket_", "range_"]).collect():  # as many as there are digests, at most
        found.setdefault(r["bucket_"], []).append(r["range_"])
    return {b: sorted(x) for b, x in sorted(found.items())}


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def read_ranges(spark: SparkSession, at: str, ranges: dict[int, list[int]] | None = None) -> DataFrame:
    """A laid-out table's records, or those of some ranges: other buckets' files aren't opened, other ranges' row groups and pages are skipped."""
    df = spark.read.parquet(f"{at}/rows")
    if ranges is not None:
        test = F.lit(False)
        for bucket, some in ranges.items():
            test = test | ((F.col("bucket_") == bucket) & F.col("range_").isin(some))
        df = df.where(F.col("bucket_").isin(list(ranges)) & F.col("range_").isin(sorted({r for x in ranges.values() for r in x}))).where(test)
    return df.drop("bucket_", "range_")


def differences(spark: SparkSession, a: str, b: str, *, id_col: str = "id") -> DataFrame:
    """(id_col, what: missing, extra or changed) of b beside a. Only ranges that differ are read."""
    ranges = differing(spark, a, b)
    x, y = read_ranges(spark, a, ranges), read_ranges(spark, b, ranges)
    digests = lambda df, name: df.groupBy(id_col).agg(F.bit_xor(_row_digest(df.columns)).alias(name), F.count("*").alias(f"n_{name}"))
    both = digests(x, "a_").join(digests(y, "b_"), id_col, "full")
    what = F.when(F.col("b_").isNull(), "missing").when(F.col("a_").isNull(), "extra").when((F.col("a_") != F.col("b_")) | (F.col("n_a_") != F.col("n_b_")), "changed")
    return both.select(id_col, what.alias("what")).where("what is not null")


def mend(spark: SparkSession, a: str, b: str, to: str, *, id_col: str = "id", buckets: int = BUCKETS, n_ranges: int = RANGES) -> int:
    """Writes to `to` what b would be if it held what a holds, laid out like both: of a, ranges that differ are read, of b the rest. Returns how many ranges differed."""
    ranges = differing(spark, a, b)
    bad = spark.createDataFrame([(k, r) for k, x in ranges.items() for r in x], "bucket_ int, range_ int")
    kept = spark.read.parquet(f"{b}/rows").join(F.broadcast(bad), ["bucket_", "range_"], "left_anti").drop("bucket_", "range_")  # as many rows as there are digests, at most
    rows = written(kept.unionByName(read_ranges(spark, a, ranges)), "mended")
    lay_out(rows, to, id_col=id_col, buckets=buckets, ranges=n_ranges)
    drop_written(rows)
    return sum(map(len, ranges.values()))
