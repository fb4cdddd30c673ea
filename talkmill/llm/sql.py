"""DuckDB SQL for the rows of those operators that SQL can express."""

from __future__ import annotations

from . import mixing, quality

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_quoted(x) if isinstance(x, str) else repr(x) for x in r) + ")" for r in rows)


def divergence(docs: str = "documents", min_words: int = 50, max_class: float = 0.22, max_word: float = 0.11) -> str:
    listed = _values([(ref, w, i) for ref, ws in quality.COMMON_WORDS.items() for i, w in enumerate(ws)])
    refs = ", ".join(map(_quoted, quality.COMMON_WORDS))
    width, classes = len(quality.COMMON_WORDS["en"]) + 1, len(quality.CLASSES) + 1
    cuts, before = [], "t"
    for i, (_, pattern) in enumerate(quality.CLASSES):
        cuts.append(f"r{i} AS (SELECT *, regexp_replace({before}, {_quoted(pattern.replace(chr(92) * 2, chr(92)))}, '', 'g') AS x{i} FROM {'w' if not i else f'r{i - 1}'})")
        before = f"x{i}"
    last = len(quality.CLASSES) - 1
    bins = " UNION ALL ".join(f"SELECT doc_id, ref, n, length(t) AS size, {i} AS bin, length({'t' if not i else f'x{i - 1}'}) - length(x{i}) AS k FROM r{last}" for i in range(last + 1))
    bins += f" UNION ALL SELECT doc_id, ref, n, length(t), {last + 1}, length(x{last}) FROM r{last}"
    chance = lambda b, n: f"sqrt({b - 1} / (8 * ln(2)) / greatest({n}, 1))"

    def js(name: str, table: str, size: str, b: int) -> str:
        return f"""
{name}_ref AS (SELECT ref, bin, sum(k) AS k FROM {table} JOIN passed USING (doc_id) WHERE n >= {min_words} GROUP BY ref, bin),
{name}_q AS (SELECT ref, bin, CAST(k AS DOUBLE) / nullif(sum(k) OVER (PARTITION BY ref), 0) AS q FROM {name}_ref),
{name}_p AS (SELECT *, CAST(k AS DOUBLE) / nullif(sum(k) OVER (PARTITION BY doc_id), 0) AS p FROM {table}),
{name} AS (SELECT doc_id, round(sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0.0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0.0 END) / 2), 0.0)), 6) AS d, {chance(b, f"max({size})")} AS c
  FROM {name}_p JOIN {name}_q USING (ref, bin) WHERE n >= {min_words} AND p IS NOT NULL AND q IS NOT NULL GROUP BY doc_id)"""

    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({refs}) THEN lang ELSE 'other' END AS ref FROM {docs}),
w AS (SELECT *, {WORDS.format("t")} AS ws, len({WORDS.format("t")}) AS n FROM d),
{", ".join(cuts)},
g AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, n - 3)) AS i FROM w WHERE n >= 5)),
f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_rep FROM f CROSS JOIN (SELECT unnest(range(5)) AS k) WHERE c > 1 GROUP BY doc_id),
passed AS (SELECT w.doc_id FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id WHERE n >= 10 AND 100 * coalesce(n_rep, 0) <= 20 * n),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
class_bins AS ({bins}),
listed(ref, word, bin) AS (VALUES {listed}),
each AS (SELECT doc_id, ref, unnest(ws) AS word FROM w),
hits AS (SELECT doc_id, bin, count(*) AS k FROM each JOIN listed ON each.ref = listed.ref AND lower(each.word) = listed.word GROUP BY doc_id, bin),
word_bins AS (SELECT w.doc_id, w.ref, w.n, listed.bin, coalesce(k, 0) AS k FROM w JOIN listed ON w.ref = listed.ref LEFT JOIN hits ON hits.doc_id = w.doc_id AND hits.bin = listed.bin
  UNION ALL SELECT w.doc_id, w.ref, w.n, {width - 1}, w.n - coalesce(h.k, 0) FROM w LEFT JOIN (SELECT doc_id, sum(k) AS k FROM hits GROUP BY doc_id) h ON h.doc_id = w.doc_id WHERE w.ref <> 'other'),
{js("jc", "class_bins", "size", classes)},
{js("jw", "word_bins", "n", width)}
SELECT r.doc_id, CAST(r.n AS BIGINT) AS n_words, CAST(length(x1) + length(t) - length(x1) - (length(x0) - length(x1)) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(x1, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words,
  (r.n < 10 OR 100 * coalesce(n_rep, 0) > 20 * r.n) AS base_failed,
  NOT (r.n < 10 OR 100 * coalesce(n_rep, 0) > 20 * r.n) AND coalesce(jc.d - jc.c <= {max_class}, true) AND coalesce(jw.d - jw.c <= {max_word}, true) AS kept,
  jc.d AS class_distance, jw.d AS word_distance
FROM r{last} r LEFT JOIN rep ON rep.doc_id = r.doc_id LEFT JOIN dup ON dup.doc_id = r.doc_id LEFT JOIN jc ON jc.doc_id = r.doc_id LEFT JOIN jw ON jw.doc_id = r.doc_id"""


def line_windows(docs: str = "documents") -> str:
    return f"""WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM {docs}),
b AS (SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT a.doc_id, a.i, a.bare AS b1, b.bare AS b2, c.bare AS b3 FROM b a JOIN b ON b.doc_id = a.doc_id AND b.i = a.i + 1 JOIN b c ON c.doc_id = a.doc_id AND c.i = a.i + 2),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY b1, b2, b3 ORDER BY doc_id, i) AS k FROM w),
gone AS (SELECT DISTINCT b.doc_id, b.pos FROM o CROSS JOIN (SELECT unnest(range(3)) AS j) JOIN b ON b.doc_id = o.doc_id AND b.i = o.i + j WHERE k > 1),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS rest FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos WHERE gone.pos IS NULL GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(CASE WHEN text IS NULL THEN NULL ELSE length(coalesce(rest, '')) END AS BIGINT) AS n_chars, CASE WHEN text IS NULL THEN NULL ELSE md5(coalesce(rest, '')) END AS text_md5
FROM {docs} d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""


def fitting(docs: str = "documents", fraction: float = 0.8, seed: str = "mix") -> str:
    targets = mixing.TARGETS
    pooled = lambda c: f"CASE WHEN {c} IN ({', '.join(_quoted(k) for k in targets[c] if k != mixing.OTHER)}) THEN {c} ELSE 'other' END"
    topics = " ".join(f"WHEN regexp_matches(t, {_quoted(p.replace(chr(92) * 2, chr(92)))}) THEN {_quoted(name)}" for name, p in mixing.TOPICS)
    steps, at = [], "base"
    for i in range(mixing.ROUNDS):
        for dim in targets:
            steps.append(f"w{i}_{dim} AS (SELECT source, lang, topic, tokens, share, t_source, t_lang, t_topic, coalesce(w * t_{dim} / nullif(sum(w) OVER (PARTITION BY {dim}), 0), 0.0) AS w FROM {at})")
            at = f"w{i}_{dim}"
        steps.append(f"w{i} AS (SELECT * REPLACE (greatest(least(w, share / {fraction}), share / {mixing.TRIM}) AS w) FROM {at})")
        at = f"w{i}"
    gaps = ", ".join(f"abs(sum(p * tokens) OVER (PARTITION BY {dim}) / nullif(sum(p * tokens) OVER (), 0) - t_{dim})" for dim in targets)
    weights = ", ".join(f"{d}_t(v, x) AS (VALUES {_values([(k, float(x)) for k, x in listed.items()])})" for d, listed in targets.items())
    shares = ", ".join(f"{d}_s AS (SELECT v, x / sum(x) OVER () AS x FROM {d}_t WHERE v IN (SELECT {d} FROM cells))" for d in targets)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {pooled("source")} AS source, {pooled("lang")} AS lang FROM {docs}),
n AS (SELECT *, len({WORDS.format("t")}) AS tokens FROM d),
k AS (SELECT *, CASE {topics} WHEN tokens < 100 THEN 'short' ELSE 'other' END AS topic FROM n),
cells AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM k GROUP BY source, lang, topic),
{weights}, {shares},
base AS (SELECT *, share AS w FROM (SELECT source, lang, topic, tokens, s.x AS t_source, l.x AS t_lang, p.x AS t_topic, coalesce(CAST(tokens AS DOUBLE) / nullif(sum(tokens) OVER (), 0), 0.0) AS share FROM cells JOIN source_s s ON s.v = source JOIN lang_s l ON l.v = lang JOIN topic_s p ON p.v = topic)),
{", ".join(steps)},
pr AS (SELECT *, coalesce(least(1.0, {fraction} * w / nullif(share, 0)), 1.0) AS p FROM {at}),
odds AS (SELECT source, lang, topic, round(p, 6) AS p, round(coalesce(greatest({gaps}), 0.0), 6) AS residual FROM pr)
SELECT k.doc_id, CAST(k.tokens AS BIGINT) AS tokens, k.source AS source_key, k.lang AS lang_key, k.topic, odds.p AS probability, odds.residual,
  CAST(('0x' || substr(md5({_quoted(seed)} || '|' || coalesce(CAST(k.doc_id AS VARCHAR), 'null' || md5(t))), 1, 8)) AS BIGINT) / 4294967296.0 < odds.p AS sampled
FROM k JOIN odds ON odds.source = k.source AND odds.lang = k.lang AND odds.topic = k.topic"""


def negatives() -> str:
    return """
with rows_ as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) as x
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), scores as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(coalesce(list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2])), 0) as bigint) as score
  from rows_ a join rows_ b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
  select anchor_id, id, score from scores where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, p.id as positive_id, cast(row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) as integer) as rank, n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scores n on n.anchor_id = p.anchor_id and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) <= 10"""
