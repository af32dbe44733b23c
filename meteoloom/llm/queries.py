"""The registered queries of this subpackage: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.working import scratch
from . import collocations, decontam, fingerprints, hard_negatives, lm_score, mixing, quality, secrets, sharding, simhash, suffix_array, suffix_tree, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(_table(spark, sf_dir, "documents"), scratch(spark, "shards"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(_table(spark, sf_dir, "documents"))


def op3_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.word_digest(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(_table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.byte_digest(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.noisy_rows(_table(spark, sf_dir, "embeddings")))


_QUERIES = (op1_sharding, op2_secrets, op3_suffix_tree_dedup, op4_mixing, op5_decontamination, op6_fingerprints, op7_toxicity, op8_lm_scoring, op9_suffix_array_dedup, op10_simhash, op11_collocations, op12_quality, op13_hard_negatives)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": OP1_SQL, "op2_secrets": op2_sql(), "op3_suffix_tree_dedup": OP3_SQL, "op4_mixing": OP4_SQL, "op9_suffix_array_dedup": OP9_SQL, "op11_collocations": OP11_SQL, "op13_hard_negatives": OP13_SQL}


OP1_SQL = "SELECT doc_id, source, lang, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS text_sha256, (SELECT COUNT(*) FROM documents) AS store_rows, true AS settled FROM documents"

# Water-filling by its level: for each source as the first open one, and the cut by a plain running sum.
OP4_SQL = r"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('20:' || doc_id) AS k FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, ROW_NUMBER() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY 1),
w AS (SELECT *, (r - 1) % 3 + 1 AS weight, 3.0::DOUBLE * source_size / ((r - 1) % 3 + 1) AS ratio FROM s),
l AS (SELECT *, ((SELECT SUM(source_size) FROM w) - COALESCE(SUM(3 * source_size) OVER o, 0))::DOUBLE / ((SELECT SUM(weight) FROM w) - COALESCE(SUM(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY ratio, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, ratio) AS level FROM l WHERE ratio > level),
t AS (SELECT w.*, LEAST(3.0 * source_size, COALESCE((SELECT level FROM f), 'infinity'::DOUBLE) * weight) AS target FROM w),
e AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM t),
p AS (SELECT *, CAST(GREATEST(0, round_even(target - whole * source_size, 0)) AS BIGINT) AS part FROM e),
c AS (SELECT d.*, p.source_size, p.target, p.whole, p.part, COALESCE(SUM(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, ROUND(target, 6) AS target, CAST(whole * size + GREATEST(0, LEAST(size, part - run)) AS BIGINT) AS taken, source FROM c"""


def op2_sql() -> str:
    """Spans from the lengths of matches and of the gaps between them, rule by rule."""
    parts = []
    for o, r in enumerate(secrets.RULES):
        pat = "'" + r.pattern.replace("'", "''") + "'"
        m, g, k = f"regexp_extract_all(t, {pat})", f"string_split_regex(t, {pat})", f"regexp_extract_all(t, {pat}, {r.group})"
        parts.append(
            f"(SELECT list_filter(list_transform(range(1, len(m) + 1), lambda i: {{'s': list_sum(list_transform(g[1:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0), "
            f"'o': {o}, 'n': length(m[i]), 'k': length(k[i])}}), lambda x: x.k >= {r.least}) FROM (SELECT {m} AS m, {g} AS g, {k} AS k))"
        )
    kinds = "[" + ", ".join(f"'{r.kind}'" for r in secrets.RULES) + "]"
    text = lambda x: f"COALESCE(array_to_string(list_transform({x}, lambda x: {kinds}[x.o + 1] || ':' || CAST(x.s AS BIGINT) || ':' || CAST(x.s + x.n AS BIGINT)), ','), '')"
    n = ", ".join(f"CAST(len(list_filter(f, lambda x: x.o = {o})) AS BIGINT) AS n_{r.kind}" for o, r in enumerate(secrets.BASE))
    base = text(f"list_filter(f, lambda x: x.o < {len(secrets.BASE)})")
    return f"WITH d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents), r AS (SELECT doc_id, list_sort(list_concat({', '.join(parts[:2])})) AS a, " + ", ".join(f"{x} AS r{i}" for i, x in enumerate(parts[2:])) + f" FROM d), s AS (SELECT doc_id, list_sort(a || {' || '.join(f'r{i}' for i in range(len(parts) - 2))}) AS f FROM r) SELECT doc_id, {n}, sha256({base}) AS base_sha256, {text('f')} AS spans FROM s"


OP3_SQL = r"""WITH w AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, unnest(list_transform(range(0, len(ws) - 19), lambda s: {'s': s, 'k': md5(array_to_string(ws[s + 1 : s + 20], ' '))})) AS x FROM w WHERE len(ws) >= 20),
f AS (SELECT x.k AS k, MIN({'d': doc_id, 's': x.s}) AS first_ FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(x.s, x.s + 20)) AS p FROM win JOIN f ON f.k = win.x.k WHERE {'d': doc_id, 's': x.s} > first_),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS p FROM w),
kept AS (SELECT words.doc_id, COUNT(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS kept FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(n_removed, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

# Bytes as pairs of hexadecimal digits.
OP9_SQL = r"""WITH d AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
blk AS (SELECT doc_id, o, h[2 * o + 1 : 2 * o + 2098] AS p FROM (SELECT doc_id, h, unnest(range(0, CAST(strlen(h) / 2 AS BIGINT) - 49, 1000)) AS o FROM d)),
win AS (SELECT doc_id, unnest(list_transform(range(0, LEAST(1000, CAST(strlen(p) / 2 AS BIGINT) - 49)), lambda i: {'s': o + i, 'k': md5(p[2 * i + 1 : 2 * i + 100])})) AS x FROM blk),
f AS (SELECT x.k AS k, MIN(doc_id) AS first_ FROM win GROUP BY 1),
late AS (SELECT doc_id, x.s AS s FROM win JOIN f ON f.k = win.x.k WHERE doc_id > first_),
island AS (SELECT doc_id, s, SUM(CASE WHEN s <= prev + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM (SELECT *, LAG(s) OVER (PARTITION BY doc_id ORDER BY s) AS prev FROM late)),
cut AS (SELECT doc_id, MIN(s) AS a, MAX(s) + 50 AS b FROM island GROUP BY doc_id, g),
per AS (SELECT doc_id, COUNT(*) AS n_spans, CAST(SUM(b - a) AS BIGINT) AS n_removed, list_sort(list({'a': a, 'b': b})) AS spans FROM cut GROUP BY 1)
SELECT d.doc_id, CAST(strlen(h) / 2 AS BIGINT) AS n_bytes, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(spans) + 1), lambda i: h[2 * CAST(CASE WHEN i = 0 THEN 0 ELSE spans[i].b END AS BIGINT) + 1 : CASE WHEN i = len(spans) THEN strlen(h) ELSE 2 * spans[i + 1].a END]), '') END)) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id)"""

# Phrases as strings; words hold no space, so equal strings are equal phrases.
OP11_SQL = r"""WITH p AS (SELECT COALESCE(lang, 'und') AS lang, unnest(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(0, len(ws) - k + 1), lambda i: array_to_string(ws[i + 1 : i + k], ' '))) AS phrase FROM w, (VALUES (1), (2), (3)) t(k) WHERE len(ws) >= k),
c AS (SELECT lang, k, phrase, COUNT(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, SUM(f) AS n FROM c WHERE k = 1 GROUP BY 1),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE k > 1 AND f >= 10),
cut AS (SELECT lang, k, phrase, a, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1 : k], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)),
s AS (SELECT cut.lang, cut.k, cut.phrase, a, j, x.f AS l, y.f AS r, CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS score FROM cut JOIN c x ON x.lang = cut.lang AND x.phrase = lp JOIN c y ON y.lang = cut.lang AND y.phrase = rp),
b AS (SELECT * FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
long AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, a AS longer FROM cand WHERE k = 3),
gone AS (SELECT DISTINCT cand.lang, cand.phrase FROM cand JOIN long ON long.lang = cand.lang AND long.phrase = cand.phrase WHERE 100 * longer >= 50 * cand.a)
SELECT b.lang, ROW_NUMBER() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM b JOIN n ON n.lang = b.lang LEFT JOIN gone ON gone.lang = b.lang AND gone.phrase = b.phrase WHERE gone.phrase IS NULL QUALIFY rank <= 2000"""

OP13_SQL = """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id, r.label, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score FROM r a, r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10"""
