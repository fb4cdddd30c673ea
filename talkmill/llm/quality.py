"""Quality rules: base counts, and the divergence of a document's histograms from those of its language."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, drop_written, unused, words, written

#: Frequent function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "as", "was", "with", "be", "by", "on", "are", "this", "from", "or"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "ein", "eine", "nicht", "als"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "au", "pas", "plus"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"],
}
#: Character classes, each what is left after those before it are taken out.
CLASSES = [("lower", "\\p{Ll}+"), ("space", "[ \\x09-\\x0D]+"), ("upper", "\\p{Lu}+"), ("digit", "\\p{Nd}+"), ("mark", "[.,;:'\"()?!-]+")]
OTHER = "other"


def _get(array: str, at: Column) -> Column:
    return F.get(F.col(array), at)


def base_counts(text: Column, df: DataFrame, p: str) -> DataFrame:
    """df with columns p_words (array), p_n (words), p_chars, p_hist (counts by class), p_symbols."""
    df = df.withColumn(f"{p}_text", F.coalesce(text.cast("string"), F.lit("")))
    df = df.withColumn(f"{p}_words", words(F.col(f"{p}_text"))).withColumn(f"{p}_n", F.size(f"{p}_words").cast("long"))
    before, sizes = f"{p}_text", []
    for name, pattern in CLASSES:
        df = df.withColumn(f"{p}_no_{name}", F.regexp_replace(before, pattern, ""))
        sizes.append((F.length(before) - F.length(f"{p}_no_{name}")).cast("long"))
        before = f"{p}_no_{name}"
    df = df.withColumn(f"{p}_hist", F.array(*sizes, F.length(before).cast("long")))
    df = df.withColumn(f"{p}_chars", (F.length(f"{p}_text") - F.get(f"{p}_hist", F.lit(1))).cast("long"))
    symbols = F.length(F.regexp_replace(f"{p}_no_space", "[^#*$%&|<>]+", "")).cast("long")
    return df.withColumn(f"{p}_symbols", symbols).drop(*(f"{p}_no_{name}" for name, _ in CLASSES))


def language(lang: Column) -> Column:
    """The reference that a document is held against: its language's, or OTHER for null and unlisted ones."""
    return F.when(lang.isin(list(COMMON_WORDS)), lang).otherwise(F.lit(OTHER))


def common_counts(words_: str, lang: Column) -> Column:
    """How often each common word of the language stands in the text as a whole word, and how many words are none of them."""
    out = F.array().cast("array<long>")
    for name, listed in COMMON_WORDS.items():
        hits = F.array(F.filter(F.transform(words_, F.lower), _isin(listed)))
        out = F.when(lang == name, F.transform(hits, _tally(listed, F.size(words_)))[0]).otherwise(out)
    return out


def _isin(listed: list[str]):
    return lambda w: w.isin(listed)


def _tally(listed: list[str], n: Column):
    """An array of how often each listed word stands in an array, then n less all of these."""
    count = lambda h, k: F.size(F.filter(h, lambda w: w == k)).cast("long")
    return lambda h: F.array(*(count(h, k) for k in listed), (n - F.size(h)).cast("long"))


def repeats(df: DataFrame, p: str, width: int = 5) -> DataFrame:
    """df with p_repeats: the words in windows of width words that are found twice or more in the text."""
    df = df.withColumn(f"{p}_h", F.transform(f"{p}_words", lambda w: F.xxhash64(w)))
    starts = F.when(F.col(f"{p}_n") >= width, F.sequence(F.lit(0), (F.col(f"{p}_n") - width).cast("int"))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(f"{p}_g", F.transform(starts, lambda i: F.xxhash64(*(_get(f"{p}_h", i + k) for k in range(width)))))
    plain = F.size(F.array_distinct(f"{p}_g")) == F.size(f"{p}_g")
    df = df.withColumn(f"{p}_s", F.when(~plain, F.array_sort(F.transform(f"{p}_g", lambda x, i: F.struct(x.alias("g"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(x["g"] == _get(f"{p}_s", k)["g"], F.lit(False))
    found = F.filter(F.transform(f"{p}_s", lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"])), lambda x: x.isNotNull())
    df = df.withColumn(f"{p}_at", F.array_sort(found))
    covered = F.aggregate(F.transform(f"{p}_at", lambda x, k: F.least(F.lit(width), F.coalesce(_get(f"{p}_at", k + 1) - x, F.lit(width)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn(f"{p}_repeats", F.coalesce(covered, F.lit(0)).cast("long")).drop(*(f"{p}_{x}" for x in ("h", "g", "s", "at")))


def js_distance(counts: Column, reference: Column) -> Column:
    """The Jensen-Shannon distance, base 2, of two histograms given as counts: 0 for equal shares, 1 for disjoint ones. Null if either holds nothing."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    shares = lambda a: F.transform(a, lambda x: F.try_divide(x.cast("double"), total(a)))
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    parts = F.zip_with(shares(counts), shares(reference), lambda p, q: (term(p, (p + q) / 2) + term(q, (p + q) / 2)) / 2)
    out = F.sqrt(F.greatest(total(parts), F.lit(0.0)))
    return F.when((total(counts) > 0) & (total(reference) > 0), out)


#: What measure() adds, as one struct.
MEASURES = "ref string, n long, chars long, size long, symbols long, dup_lines long, repeats long, hist array<long>, common array<long>, no long"


def measure(docs: DataFrame, name: str, *, columns: list[str] | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """columns of docs (all, if not given) and a struct `name` of MEASURES: the language's reference, words, their characters, characters, symbols, repeated lines, words in repeated windows, and the two histograms. In one pass over the texts.

    The struct holds a running number too, which is no part of the result: Spark moves no filter below a projection that isn't deterministic, and would else write a filter on the measures out through all the steps to them, many times over.
    """
    own = docs.columns if columns is None else columns
    (p,) = unused(docs, "q")
    while any(c.lower().startswith(p + "_") for c in docs.columns):
        p += "q"
    df = base_counts(col(text_col), docs.withColumn(f"{p}_ref", language(col(lang_col).cast("string"))), p)
    df = repeats(df.withColumn(f"{p}_common", common_counts(f"{p}_words", F.col(f"{p}_ref"))), p)
    lines = F.filter(F.split(f"{p}_text", "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))
    dup = F.size(f"{p}_lines") - F.size(F.array_distinct(f"{p}_lines"))
    found = {"ref": F.col(f"{p}_ref"), "n": F.col(f"{p}_n"), "chars": F.col(f"{p}_chars"), "size": F.length(f"{p}_text"), "symbols": F.col(f"{p}_symbols"), "dup_lines": dup, "repeats": F.col(f"{p}_repeats"), "hist": F.col(f"{p}_hist"), "common": F.col(f"{p}_common"), "no": F.monotonically_increasing_id()}
    whole = F.struct(*(c.alias(k) for k, c in found.items())).cast(f"struct<{MEASURES.replace(' ', ':').replace(',:', ',')}>")
    return df.withColumn(f"{p}_lines", lines).select(*map(col, own), whole.alias(name))


def _base_failed(m: Column) -> Column:
    return (m["n"] < 10) | (100 * m["repeats"] > 20 * m["n"])


def _references(measured: DataFrame, name: str, min_words: int) -> DataFrame:
    m = col(name)
    sums = lambda c, n: F.array(*(F.sum(F.coalesce(F.get(m[c], F.lit(i)), F.lit(0))) for i in range(n)))
    width = max(map(len, COMMON_WORDS.values())) + 1
    rows = measured.select(m.alias(name)).where((m["n"] >= min_words) & ~_base_failed(m))
    return rows.groupBy(m["ref"].alias("ref")).agg(sums("hist", len(CLASSES) + 1).alias("ref_hist"), sums("common", width).alias("ref_common"))


def references(docs: DataFrame, *, min_words: int = 50, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per language: ref, ref_hist, ref_common: character classes and common words, summed over the documents of min_words words or more that pass the base rules. At most len(COMMON_WORDS) + 1 rows; written, so that they can be learned once from trusted text and kept for judge()."""
    measured = written(measure(docs, "m", columns=[], text_col=text_col, lang_col=lang_col), "measured")
    out = written(_references(measured, "m", min_words), "references")
    drop_written(measured)
    return out


#: For judge(), whose parameter has the same name.
learned = references


def judge(docs: DataFrame, *, references: DataFrame | None = None, columns: list[str] | None = None, min_words: int = 50, max_class_distance: float = 0.22, max_word_distance: float = 0.11, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """columns of docs (all, if not given) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), class_distance, word_distance (double), base_failed, kept (boolean). A column of docs of such a name gives way to it.

    Base rules reject texts under 10 words, and those in which repeated five-word windows hold over a fifth of the words. Of the others, those of min_words words or more are kept if the Jensen-Shannon distances of their character classes and of their common words to the reference of their language are within the maxima. From each distance that is first taken which a sample of that many words or characters has on average by chance, sqrt((bins - 1) / (8 n ln 2)). Shorter ones, whose histograms say little, are kept.
    References are those given (as references() makes them, from trusted text: a document's verdict then rests on it alone), or else those of the documents of docs that pass the base rules. A language without a reference rejects nothing.

    Only DataFrame functions; no shuffle of texts. Where references are to be learned and texts aren't among the columns, measures are written once and serve both; else texts are measured once for the references and once for the verdicts, so that no text is copied. The references are broadcast: one row per listed language and one for the rest.
    Null text counts as empty: no words, rejected. Null or unlisted languages are held against the reference of all such, by character classes alone. Rows with equal ids are judged one by one. A null id stays null. An empty table gives no rows.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept"]
    own = [c for c in (docs.columns if columns is None else columns) if c.lower() not in made]
    name, key, rh, rc = unused(docs, "q_m", "q_key", "q_rh", "q_rc")
    measured = measure(docs, name, columns=own, text_col=text_col, lang_col=lang_col)
    if references is None and text_col not in own:
        measured = written(measured, "measured")
        references = _references(measured, name, min_words)
    elif references is None:
        references = learned(docs, min_words=min_words, text_col=text_col, lang_col=lang_col)
    refs = references.select("ref", "ref_hist", "ref_common")
    df = measured.join(F.broadcast(refs.toDF(key, rh, rc)), col(name)["ref"] == F.col(key), "left")
    m = col(name)
    n, far = m["n"], m["n"] >= min_words
    by_class, by_word = (F.round(F.when(far, js_distance(a, F.col(b))), 6) for a, b in ((m["hist"], rh), (m["common"], rc)))
    chance = lambda bins, size: F.sqrt(F.lit((bins - 1) / (8 * math.log(2))) / F.greatest(size, F.lit(1)))
    over = lambda distance, bins, size, most: F.coalesce(distance - chance(bins, size) > most, F.lit(False))
    within = ~over(by_class, len(CLASSES) + 1, m["size"], max_class_distance) & ~over(by_word, len(COMMON_WORDS["en"]) + 1, n, max_word_distance)
    values = [n, m["chars"], m["symbols"], m["dup_lines"], m["repeats"], by_class, by_word, _base_failed(m), ~_base_failed(m) & within]
    return df.select(*map(col, own), *(c.alias(k) for k, c in zip(made, values)))
