"""Mixing to target weights by iterative proportional fitting, then sampling by calibrated probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, unused, words

OTHER = "other"
#: Target weights by source, language and topic; what isn't listed is pooled as OTHER.
TARGETS = {
    "source": {"src0": 0.6} | {f"src{i}": 1.0 for i in range(1, 20)} | {OTHER: 0.5},
    "lang": {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.1, OTHER: 0.01},
    "topic": {"contact": 0.008, "licence": 0.02, "figures": 0.045, "short": 0.02, OTHER: 0.907},
}
#: Topics by what a text holds; the first that fits counts.
TOPICS = [("contact", "[^ \\t-\\r]@[^ \\t-\\r]+\\.[a-z]"), ("licence", "(?i)licen[sc]ed|copyright"), ("figures", "[0-9]")]
ROUNDS = 12
#: By what factor a cell's weight may fall short of its share, at most.
TRIM = 8.0


def topic(text: Column, n_words: Column) -> Column:
    """The first topic of TOPICS whose pattern is found in the text; else short (under 100 words) or OTHER."""
    out = F
    for name, pattern in TOPICS:
        out = (F.when if out is F else out.when)(text.rlike(pattern), F.lit(name))
    return out.when(n_words < 100, F.lit("short")).otherwise(F.lit(OTHER))


def pooled(value: Column, listed: dict[str, float]) -> Column:
    return F.when(value.isin([k for k in listed if k != OTHER]), value).otherwise(F.lit(OTHER))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]], *, fraction: float = 0.8, rounds: int = ROUNDS, trim: float = TRIM) -> DataFrame:
    """cells (the targets' keys as columns, tokens) with w, p and residual.

    w: shares of the total, raked in turn to each target's marginals, scaled to those values that have tokens. A cell can't give more than it has: when `fraction` of all tokens is to be kept, its weight is at most its own share over fraction; and at least its share over trim, so that marginals that the cells can't reach together lose no cell. Weights are cut to these bounds in each round, so that the next one makes up for it in other cells as far as these can.
    p: the probability to keep a token of the cell, fraction * w / share, which is 1 at most.
    residual: what is left: the largest difference, among the cell's marginals, between the share of the tokens to be expected and the target.
    There are at most as many cells as the targets' listed values times each other, whatever the corpus: one partition holds them, and rounds are windows over it.
    """
    df = cells.repartition(1)  # of sums that were formed in parallel
    everything = Window.partitionBy(F.lit(1))
    for dim, listed in targets.items():
        weight = F
        for value, x in listed.items():
            weight = (F.when if weight is F else weight.when)(F.col(dim) == value, F.lit(float(x)))
        df = df.withColumn(f"t_{dim}", weight.otherwise(F.lit(0.0)))
        size = Window.partitionBy(dim)
        first = F.row_number().over(size.orderBy(*(d for d in targets if d != dim)))
        df = df.withColumn(f"f_{dim}", F.when(first == 1, F.col(f"t_{dim}")).otherwise(0.0))
        df = df.withColumn(f"t_{dim}", F.try_divide(F.col(f"t_{dim}"), F.sum(f"f_{dim}").over(everything))).drop(f"f_{dim}")
    df = df.withColumn("share", F.coalesce(F.try_divide(F.col("tokens").cast("double"), F.sum("tokens").over(everything)), F.lit(0.0))).withColumn("w", F.col("share"))
    for _ in range(rounds):
        for dim in targets:
            df = df.withColumn("w", F.coalesce(F.try_divide(F.col("w") * F.col(f"t_{dim}"), F.sum("w").over(Window.partitionBy(dim))), F.lit(0.0)))
        df = df.withColumn("w", F.greatest(F.least("w", F.col("share") / fraction), F.col("share") / trim))
    df = df.withColumn("p", F.coalesce(F.least(F.lit(1.0), F.try_divide(fraction * F.col("w"), F.col("share"))), F.lit(1.0)))
    kept = lambda w: F.sum(F.col("p") * F.col("tokens")).over(w)
    gap = lambda dim: F.abs(F.try_divide(kept(Window.partitionBy(dim)), kept(everything)) - F.col(f"t_{dim}"))
    df = df.withColumn("residual", F.coalesce(F.greatest(*map(gap, targets)), F.lit(0.0)))
    return df.drop("share", *(f"t_{dim}" for dim in targets))


def achieved(mixed: DataFrame, targets: dict[str, dict[str, float]] = TARGETS) -> DataFrame:
    """(dim, value, target, before, expected, sampled) of what mix() gave: each listed value's target share, among the values that have words, and its share of the words before, by the probabilities, and in the sample."""
    keys = {"source": "source_key", "lang": "lang_key", "topic": "topic"}
    sums = {"before": F.col("tokens"), "expected": F.col("tokens") * F.col("probability"), "sampled": F.when(F.col("sampled"), F.col("tokens")).otherwise(0)}
    listed = mixed.sparkSession.createDataFrame([(d, v, float(x)) for d, values in targets.items() for v, x in values.items()], "dim string, value string, target double")
    cells = mixed.groupBy(*(keys[d] for d in targets)).agg(*(F.sum(c).cast("double").alias(n) for n, c in sums.items()))
    each = F.explode(F.array(*(F.struct(F.lit(d).alias("dim"), F.col(keys[d]).alias("value")) for d in targets)))
    rows = cells.select(*sums, each.alias("m")).groupBy("m.dim", "m.value").agg(*(F.sum(n).alias(n) for n in sums)).join(F.broadcast(listed), ["dim", "value"])
    of = Window.partitionBy("dim")
    return rows.select("dim", "value", *(F.try_divide(n, F.sum(n).over(of)).alias(n) for n in ("target", *sums)))


def draw(*by: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *by)), 1, 8), 16, 10).cast("double") / 2.0**32


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] = TARGETS, *, fraction: float = 0.8, seed: str = "mix", rounds: int = ROUNDS, trim: float = TRIM, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """docs with tokens (words), source_key, lang_key, topic, probability, residual (double, 6 digits) and sampled (boolean). Columns of docs of these names give way.

    1. Words are summed by (source, language, topic), values that targets doesn't list pooled as OTHER: 630 cells at most for TARGETS, however the corpus is skewed; sums are formed where rows are read.
    2. Cells are raked to the marginals and given probabilities that keep the given fraction of all words; less, where targets are out of reach, for no cell gives more than it has (rake).
    3. Rows meet their cell in a broadcast join of those cells and are drawn by a hash of seed and id, so that a run can be repeated. No row is shuffled.
    How near the targets are is told by residual, for the row's cell, and by achieved(). The smaller the fraction, the nearer they can be.
    Only DataFrame functions.

    Null source or language is pooled as OTHER; null text has no words and topic "short". Rows without words fall under their cell like others. A row with a null id is drawn by its text. Rows with equal ids are drawn alike. An empty table gives no rows.
    """
    made = {"tokens": "tokens", "source": "source_key", "lang": "lang_key", "topic": "topic"}
    own = [c for c in docs.columns if c.lower() not in {*made.values(), "probability", "residual", "sampled"}]
    names = dict(zip(made, unused(docs, *(f"m_{x}" for x in made))))
    df = docs.withColumn(names["tokens"], F.size(words(col(text_col).cast("string"))).cast("long"))
    df = df.withColumn(names["topic"], topic(F.coalesce(col(text_col).cast("string"), F.lit("")), F.col(names["tokens"])))
    df = df.withColumns({names["source"]: pooled(col(source_col).cast("string"), targets["source"]), names["lang"]: pooled(col(lang_col).cast("string"), targets["lang"])})
    dims = list(targets)
    cells = df.groupBy(*(F.col(names[d]).alias(d) for d in dims)).agg(F.sum(names["tokens"]).alias("tokens"))
    p, gap, *keys = unused(df, "m_p", "m_gap", *(f"m_k_{d}" for d in dims))
    odds = rake(cells, targets, fraction=fraction, rounds=rounds, trim=trim).select(*(F.col(d).alias(k) for d, k in zip(dims, keys)), F.round("p", 6).alias(p), F.round("residual", 6).alias(gap))
    df = df.join(F.broadcast(odds), [F.col(names[d]) == F.col(k) for d, k in zip(dims, keys)], "left")
    text = F.concat(F.lit("null"), F.md5(F.coalesce(col(text_col).cast("string"), F.lit(""))))
    sampled = draw(F.lit(seed), F.coalesce(col(id_col).cast("string"), text)) < F.col(p)
    return df.select(*map(col, own), *(F.col(names[k]).alias(v) for k, v in made.items()), F.col(p).alias("probability"), F.col(gap).alias("residual"), sampled.alias("sampled"))
