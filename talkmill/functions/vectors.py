"""Vector expressions over ARRAY<FLOAT> columns, in double precision."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


#: Sizes up to which a product with a known vector is written out.
WRITTEN_OUT = 128


def dot_with(v: Column, query: list[float]) -> Column:
    """The product with a query known when the plan is made: a plain sum that code is generated for; for large vectors, of which that would be too much code, a walk along both."""
    if len(query) > WRITTEN_OUT:
        return dot(v, F.array(*(F.lit(float(x)) for x in query)))
    return reduce(lambda a, b: a + b, (F.get(v, F.lit(i)).cast("double") * F.lit(float(x)) for i, x in enumerate(query)))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def unit(v: Column) -> Column:
    return F.transform(doubles(v), lambda x: F.try_divide(x, norm(v)))


def all_close(a: Column, b: Column, atol: float = 1e-4, rtol: float = 1e-5) -> Column:
    """Equal sizes, and |a - b| <= atol + rtol * |b| everywhere: the bound follows b."""
    near = F.forall(F.zip_with(doubles(a), doubles(b), lambda x, y: F.abs(x - y) <= atol + rtol * F.abs(y)), lambda ok: F.coalesce(ok, F.lit(False)))
    return (F.size(a) == F.size(b)) & near


def all_finite(v: Column) -> Column:
    return F.forall(doubles(v), lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))


def centroids(df: DataFrame, keys: list[str], vector: str = "vector", weight: str | None = None, name: str = "centroid") -> DataFrame:
    """The weighted mean of each group's vectors, of unit length: keys, name, n. Sums go dimension by dimension with partial sums where rows are read, so that a large group costs no more than its share of rows.

    Raises, while the query runs, on a weight sum that isn't positive, on vectors of different sizes in a group and on a mean without length. Null vectors don't count; a group with none has no row.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(vector).isNotNull()).select(*keys, w.alias("w_"), F.size(vector).alias("dim_"), F.posexplode(doubles(F.col(vector))).alias("i_", "x_"))
    sums = rows.groupBy(*keys, "i_").agg(F.sum(F.col("x_") * F.col("w_")).alias("s_"), F.sum("w_").alias("t_"), F.min("dim_").alias("lo_"), F.max("dim_").alias("hi_"), F.count("*").alias("n_"))
    means = F.try_divide(F.col("s_"), F.col("t_"))
    joined = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i_", means.alias("m_")))).alias("v_"), F.min("t_").alias("t_"), F.min("lo_").alias("lo_"), F.max("hi_").alias("hi_"), F.max("n_").alias("n"))
    mean = F.transform("v_", lambda x: x["m_"])
    length = F.sqrt(total(F.transform(mean, lambda x: x * x)))
    checked = F.when(F.col("t_") <= 0, F.raise_error(F.lit("the weights' sum must be positive"))).when(F.col("lo_") != F.col("hi_"), F.raise_error(F.lit("vectors differ in size"))).when(length == 0, F.raise_error(F.lit("a centroid has no length"))).otherwise(F.transform(mean, lambda x: x / length))
    return joined.select(*keys, checked.alias(name), "n")


def percentile(values: Column, q: float) -> Column:
    """The value at place int(q * n) of the sorted array, the last one at most; 0 for an empty array. It isn't interpolated."""
    ordered, n = F.array_sort(values), F.size(values)
    return F.when(n > 0, F.get(ordered, F.least(F.floor(F.lit(q) * n), n - 1).cast("int"))).otherwise(F.lit(0.0))


#: Ranges into which values are cut before they are ranked.
RANGES = 128


def _ranked(counts: DataFrame, on: list[str]) -> DataFrame:
    """counts (on, distinct values x_, n_) with upto_, the number of a group's values up to x_, and all_, that of all."""
    cuts = counts.groupBy(*on).agg(F.percentile_approx("x_", [i / RANGES for i in range(1, RANGES)], 1000).alias("cuts_"))
    joined = counts.join(cuts, on) if on else counts.crossJoin(F.broadcast(cuts))  # one row
    ranged = joined.withColumn("r_", F.size(F.filter("cuts_", lambda c: c < F.col("x_")))).drop("cuts_")
    by = Window.partitionBy(*(on or [F.lit(1)]))
    totals = ranged.groupBy(*on, "r_").agg(F.sum("n_").alias("t_"))
    totals = totals.withColumn("before_", F.coalesce(F.sum("t_").over(by.orderBy("r_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("all_", F.sum("t_").over(by)).drop("t_")
    within = Window.partitionBy(*on, "r_").orderBy("x_")
    return ranged.withColumn("upto_", F.sum("n_").over(within)).join(totals, [*on, "r_"]).withColumn("upto_", F.col("before_") + F.col("upto_"))


def exact_percentiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Percentiles as above for groups of any size. Values are counted first; distinct ones are cut into RANGES by approximate percentiles, ranked within a range, and ranges are put in order by their totals. So no task ranks a group whole, and the result is exact wherever the cuts fall."""
    name = lambda i: f"k{i}_"
    on = [name(i) for i in range(len(keys))]
    counts = df.where(F.col(value).isNotNull()).groupBy(*(F.col(k).alias(o) for k, o in zip(keys, on)), F.col(value).alias("x_")).agg(F.count("*").alias("n_"))
    ranked = _ranked(counts, on)
    at = lambda q: F.least(F.floor(F.lit(q) * F.col("all_")), F.col("all_") - 1)
    out = ranked.groupBy(*on).agg(*(F.min(F.when(F.col("upto_") > at(q), F.col("x_"))).alias(n) for n, q in qs.items()))
    return out.select(*(F.col(o).alias(k) for k, o in zip(keys, on)), *qs)


#: Slots of a unit by which values are counted before any of them is moved.
SLOTS = 1 << 14


def at_ranks(df: DataFrame, value: str, ranks: dict[str, Callable[[Column], Column]], counted: dict[str, Column] | None = None) -> DataFrame:
    """One row: n, the number of values that aren't null, counts `counted` over df's rows, and for each name the value at the rank (from 0) that its function gives for n; null where there is none. For many values that are cheap to make and of a small range, as cosines: df is gone over twice, first to count values by slots, then for the values of the slots that the ranks fall in, which alone are moved and ranked."""
    x = F.col(value)
    slot = F.when(F.isnan(x), F.lit((1 << 63) - 1)).otherwise(F.floor(x * SLOTS))  # in order of values
    more = counted or {}
    slots = df.groupBy(slot.alias("s_")).agg(F.count(value).alias("c_"), *(c.alias(k) for k, c in more.items()))
    held = slots.agg(F.array_sort(F.collect_list(F.when(F.col("s_").isNotNull(), F.struct("s_", "c_")))).alias("l_"), F.coalesce(F.sum("c_"), F.lit(0)).alias("n"), *(F.sum(k).alias(k) for k in more)).first()  # no more than slots
    n, wanted = held["n"], {}
    whole = df.sparkSession.range(1).select(F.lit(n).cast("long").alias("n"), *(F.lit(held[k] or 0).alias(k) for k in more))
    places = df.sparkSession.range(1).select(*(f(F.lit(n)).cast("long").alias(k) for k, f in ranks.items())).first().asDict()
    for k, place in places.items():
        before = 0
        for s, c in held["l_"]:
            if before <= place < before + c:
                wanted[k] = (s, place - before)
            before += c
    if not wanted:
        return whole.select("*", *(F.lit(None).cast("double").alias(k) for k in ranks))
    kept = df.where(slot.isin(sorted({s for s, _ in wanted.values()}))).groupBy(slot.alias("s_"), x.alias("x_")).agg(F.count("*").alias("n_"))
    pick = lambda k: F.min(F.when((F.col("s_") == wanted[k][0]) & (F.col("upto_") > wanted[k][1]), F.col("x_"))) if k in wanted else F.lit(None).cast("double")
    return whole.crossJoin(F.broadcast(_ranked(kept, ["s_"]).agg(*(pick(k).alias(k) for k in ranks))))  # one row each


def percentile_rank(q: float) -> Callable[[Column], Column]:
    """The place that percentile() looks at."""
    return lambda n: F.least(F.floor(F.lit(q) * n), n - 1)
