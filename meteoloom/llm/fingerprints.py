"""Document fingerprints by consistent weighted sampling (DataFrame functions only).

A text is a vector of term weights (how often each word occurs). For sample k, term t draws
r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) from hashes of (t, k) alone. With weight w, let
m = floor(ln w / r + b); the sample is the (t, m) with the least
ln a = ln c - r * (m - b + 1). Two texts agree on a sample with the probability of their
generalised Jaccard similarity (sum of the lesser weights / sum of the greater ones). As ln a
depends on (t, m) and k alone, the least value itself stands for the sampled pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SAMPLES = 32
#: Hex digits kept of each sample.
DIGITS = 4


def _uniform(bits: Column) -> Column:
    """32 bits as a number in (0, 1)."""
    return (bits + F.lit(0.5)) / F.lit(float(2**32))


def _log_a(term: Column, log_weight: Column, k: int) -> Column:
    """ln a of sample k; ``term`` is a 64-bit hash."""
    h = [F.xxhash64(term, F.lit(3 * k + i)) for i in range(3)]
    low, high = (lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))), (lambda x: F.shiftrightunsigned(x, 32))
    r = -F.ln(_uniform(low(h[0])) * _uniform(high(h[0])))
    log_c = F.ln(-F.ln(_uniform(low(h[1])) * _uniform(high(h[1]))))
    b = _uniform(low(h[2]))
    return log_c - r * (F.floor(log_weight / r + b) - b + 1)


def _least(rows: DataFrame, keys: list[str], samples: int) -> DataFrame:
    """rows (keys, _t, _lw) -> keys and the least ln a of each sample, ``_a0`` and so on."""
    return rows.groupBy(*keys).agg(*[F.min(_log_a(F.col("_t"), F.col("_lw"), k)).alias(f"_a{k}") for k in range(samples)])


def _digits(least: list[Column]) -> Column:
    """The fingerprint of the least values of all samples; as ``blank`` where they are null."""
    return F.concat(*[F.substring(F.lpad(F.lower(F.hex(F.xxhash64(a))), 16, "0"), 1, DIGITS) for a in least])


def _terms(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    words = texts.select(*keys, F.explode(F.split(text, r"[\x20\x09-\x0D]+")).alias("_word")).where("_word != ''")
    return words.select(*keys, F.xxhash64("_word").alias("_t"))


def signatures(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """texts (keys, text), already partitioned by a subset of ``keys`` -> keys, ``fingerprint``.

    ``keys`` identify a text. Terms are counted inside the partition that holds it, so nothing is
    shuffled. Texts without a word have no row.
    """
    counts = _terms(texts, keys, "text").groupBy(*keys, "_t").count()
    least = _least(counts.withColumn("_lw", F.ln("count")), keys, samples)
    return least.select(*keys, _digits([F.col(f"_a{k}") for k in range(samples)]).alias("fingerprint"))


def paired_signatures(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """texts (keys, text, edited) -> keys, ``_f0`` and ``_f1``: the fingerprints of both texts.

    A term that both hold equally often draws its samples once for both. Otherwise as ``signatures``.
    """
    version = lambda v, c: F.struct(F.lit(v).alias("v"), F.col(c).alias("x"))
    both = texts.select(*keys, F.inline(F.array(version(0, "text"), version(1, "edited"))))
    terms = _terms(both, [*keys, "v"], "x")
    n = terms.groupBy(*keys, "_t").agg(*[F.sum(F.when(F.col("v") == v, 1).otherwise(0)).alias(f"_n{v}") for v in (0, 1)])
    row = lambda v: F.when(F.col(f"_n{v % 2}") > 0, F.struct(F.lit(v).alias("v"), F.ln(f"_n{v % 2}").alias("_lw")))
    rows = n.select(*keys, "_t", F.inline(F.when(F.col("_n0") == F.col("_n1"), F.array(row(2))).otherwise(F.array_compact(F.array(row(0), row(1))))))
    least = _least(rows, [*keys, "v"], samples)
    # Version 2 stands for both.
    of = lambda v: [F.min(F.when(F.col("v") != 1 - v, F.col(f"_a{k}"))).alias(f"_m{v}_{k}") for k in range(samples)]
    each = least.groupBy(*keys).agg(*of(0), *of(1))
    return each.select(*keys, *[_digits([F.col(f"_m{v}_{k}") for k in range(samples)]).alias(f"_f{v}") for v in (0, 1)])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    same = [(F.substring(a, 1 + DIGITS * k, DIGITS) == F.substring(b, 1 + DIGITS * k, DIGITS)).cast("int") for k in range(samples)]
    return sum(same[1:], same[0]) / F.lit(float(samples))


def blank(samples: int = SAMPLES) -> str:
    """The fingerprint of a text without a word; it equals itself and (but for chance) no other."""
    return "0" * (DIGITS * samples)


def _keyed(docs: DataFrame) -> DataFrame:
    """_id (doc_id, which may be null, as a struct that never is), _h (hash of the text), text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.struct("doc_id").alias("_id"), F.xxhash64(text).alias("_h"), text.alias("text"))


def _once(keyed: DataFrame) -> DataFrame:
    """Rows with equal _id and _h once, with how many there are (``_copies``); partitioned by _id."""
    same = Window.partitionBy("_id", "_h").orderBy("_h")
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = keyed.repartition("_id").withColumns({"_n": F.row_number().over(same), "_copies": F.count("*").over(every)})
    return counted.where("_n = 1").drop("_n")


def _each(df: DataFrame) -> DataFrame:
    """Every row as often as ``_copies`` tells."""
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))).drop("_copy", "_copies")


def fingerprint(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, fingerprint for every row; null texts count as empty (see ``blank``).

    Repeated rows, and rows that share a doc_id or have none, are fingerprinted each.
    """
    held = _once(_keyed(docs))
    signed = signatures(held, ["_id", "_h"], samples)
    out = _each(held.select("_id", "_h", "_copies").join(signed, ["_id", "_h"], "left"))
    return out.select("_id.doc_id", F.coalesce("fingerprint", F.lit(blank(samples))).alias("fingerprint"))


def successors(ids: DataFrame) -> DataFrame:
    """ids (doc_id, any columns) -> the same rows with ``next_id``, the next greater doc_id; the last gets the first.

    Ids are ranged into blocks; the successor is found inside the block, and for the last one
    of a block in the table of block heads, which has one row for each range partition. Equal
    ids share a successor. Nulls come first. The blocks are stored, as ranging samples its
    borders anew wherever it is computed.
    """
    n = max(1, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    distinct = ids.select("doc_id").distinct()
    blocks = distinct.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).withColumn("_block", F.spark_partition_id())
    blocks = materialize(blocks, "fingerprint-blocks")
    order = Window.partitionBy("_block").orderBy(F.col("doc_id").asc_nulls_first())
    placed = blocks.withColumns({"_rank": F.row_number().over(order), "_next": F.lead(F.struct("doc_id")).over(order)})
    heads = placed.where("_rank = 1").select("_block", F.struct("doc_id").alias("_head"))
    whole = Window.orderBy("_block")
    heads = heads.withColumn("_after", F.coalesce(F.lead("_head").over(whole), F.first("_head").over(whole)))
    heads = heads.select(F.col("_block").alias("_b"), "_after")
    placed = placed.join(F.broadcast(heads), F.col("_block") == F.col("_b"))  # a row for each range partition
    return placed.select("doc_id", F.coalesce("_next", "_after")["doc_id"].alias("next_id"))


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text (the columns of the registered query).

    The edited text has its last floor(n/4) code points replaced by the first as many (or all)
    of the next document. Null texts count as empty, and a text of under four code points is its
    own edited text. Every row is a document, repeated ones too. A null doc_id comes before all
    others; where rows with different texts share the next doc_id, the text with the least hash
    is the next one. An only doc_id is its own next one. One text shuffle by doc_id fetches the
    heads that the edits need, a second one serves both fingerprints.
    """
    keyed, keys = _keyed(docs), ["_id", "_h"]
    order = successors(docs.select("doc_id")).select(F.struct("doc_id").alias("_for"), F.struct(F.col("next_id").alias("doc_id")).alias("_of"))
    longest = keyed.groupBy("_id").agg(F.max(F.char_length("text")).alias("_longest"))
    wanted = order.join(longest, F.col("_for") == F.col("_id")).select("_for", "_of", F.floor(F.col("_longest") / 4).cast("int").alias("_most"))
    first = keyed.repartition("_id").withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy("_h"))).where("_n = 1")
    heads = wanted.join(first, F.col("_of") == F.col("_id")).select("_for", "_of", F.col("_h").alias("_of_h"), F.expr("left(text, _most)").alias("_head"))
    # Written with nothing else holding its plan, so that this text shuffle goes before the next.
    heads = materialize(heads, "fingerprint-heads")
    q = F.floor(F.char_length("text") / 4).cast("int")
    both = _once(keyed).join(heads.select("_for", "_head"), F.col("_id") == F.col("_for")).withColumn("_q", q)
    edited = F.when(F.col("_q") > 0, F.concat(F.expr("left(text, char_length(text) - _q)"), F.expr("left(_head, _q)"))).otherwise(F.col("text"))
    both = both.select(*keys, "_copies", "text", edited.alias("edited"))
    facts = both.select(*keys, "_copies", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    none = F.lit(blank(samples))
    signed = facts.join(paired_signatures(both, keys, samples), keys, "left")
    signed = signed.select(*keys, "_copies", "n_chars", "edited_sha256", F.coalesce("_f0", none).alias("fingerprint"), F.coalesce("_f1", none).alias("edited_fingerprint"))
    signed = materialize(signed, "fingerprint-signed")
    of = heads.select("_for", "_of", "_of_h").join(signed.select(F.col("_id").alias("_of"), F.col("_h").alias("_of_h"), F.col("fingerprint").alias("_next")), ["_of", "_of_h"])
    out = _each(signed.join(of.select("_for", "_next"), F.col("_id") == F.col("_for")))
    f = F.col("fingerprint")
    return out.select("_id.doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(f, F.col("edited_fingerprint"), samples).alias("near_edited"), likeness(f, F.col("_next"), samples).alias("near_next"))
