"""Mixing sources to target weights by capped water-filling (DataFrame functions only).

Every source asks for a share of the total in proportion to its weight and is clamped at
``max_epochs`` times its own size; the excess goes to the sources below their clamp, again by
weight, until none is above. That fixed point is one water level: sources whose cap per weight
it reaches are full, and the others get level x weight.

A source's target is then drawn as whole repetitions of all its documents plus a fractional
one: documents in a seeded order until the words still wanted are reached. The order is by the
MD5 of seed and doc_id, so it is the same in every run. Cumulated sizes come in two steps, by
4096 hash bins per source and then inside the one bin where the target falls, so that a source
with most of the rows is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import global_rank
from .common import materialize, word_count

SEED = 20
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources (source, weight, source_size), one row per source -> adds ``target`` (double).

    Starting with no source full, the level that the open ones share fills those whose cap per
    weight it reaches, which raises it for the others, until none is added. Each round is one
    aggregation over the sources; four numbers reach the driver. Sources of size 0 get target 0.
    An empty table stays empty.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, before = 0.0, None
    while total is not None:
        full = (cap / F.col("weight")) <= F.lit(level)
        state = sources.agg(F.sum(F.when(full, cap)), F.sum(F.when(full, F.col("weight")))).first() if level else (0, 0)
        if tuple(state) == before:
            break
        before = tuple(state)
        level = (total - (state[0] or 0)) / (weight - (state[1] or 0)) if weight > (state[1] or 0) else float("inf")
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    return sources.select("source", "weight", "source_size", target.alias("target"))


def weighted_sources(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources of ``sized`` (source, size) with their sizes; by code point, null last, weights repeat."""
    # Summed in every task first, whatever the source's share of the rows.
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(sums, [F.col("source").asc_nulls_last()], "_rank")
    return ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1)).drop("_rank")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, whole: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, copies.

    ``taken`` counts the words that the mix takes of the document, repeats included; ``copies``
    is taken / size (0 for an empty document). The document at which the fractional repetition
    ends gives only the words still wanted; with ``whole`` it counts fully if more than half of
    it is wanted, else not at all. Null texts have size 0, a null source is a source of its
    own, rows that repeat a doc_id are mixed each on their own, and ties in the order are
    broken by doc_id, size and a hash of the text. Other columns are ignored.
    """
    return _plan(docs, weights, max_epochs, seed, whole).drop("_h")


def _plan(docs: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: int, whole: bool) -> DataFrame:
    """``mix`` and the hash of each row's text, ``_h``."""
    text_h = F.xxhash64("text")
    # Rows without an id are spread by their texts.
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null"), F.hex(text_h)))))
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_h.alias("_h"), key.alias("_key"))
    sized = materialize(sized.withColumn("_bin", F.substring("_key", 1, 3)), "mix-sizes")
    targets = water_fill(materialize(weighted_sources(sized, weights), "mix-sources"), max_epochs=max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("_whole", F.least(F.floor(epochs), F.lit(max_epochs)).cast("long"))
    targets = targets.withColumn("_part", F.greatest(F.lit(0), F.bround(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long")))

    bins = sized.groupBy("source", "_bin").agg(F.sum("size").alias("_size"))
    upto = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_before", F.coalesce(F.sum("_size").over(upto), F.lit(0)))
    t = targets.withColumnRenamed("source", "_source")
    # At most 4096 bins for each source, and one row of targets for each.
    bins = bins.join(t, bins["source"].eqNullSafe(t["_source"])).drop("_source")
    bins = bins.withColumn("_wanted", F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_part") - F.col("_before"))))
    bins = bins.select(F.col("source").alias("_s"), F.col("_bin").alias("_b"), "source_size", "target", "_whole", "_size", "_wanted")
    d = sized.join(bins, sized["source"].eqNullSafe(bins["_s"]) & (sized["_bin"] == bins["_b"]), "left")

    # Only the bin in which a source's target falls needs the order of its documents.
    cut = (F.col("_wanted") > 0) & (F.col("_wanted") < F.col("_size"))
    inside = Window.partitionBy("source", "_bin", F.when(cut, F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(4096)))).orderBy("_key", "doc_id", "size", "_h")
    d = d.withColumn("_run", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_wanted") - F.col("_run")))
    if whole:
        rest = F.when(rest * 2 > F.col("size"), F.col("size")).otherwise(F.lit(0))
    rest = F.when(F.col("_wanted") >= F.col("_size"), F.col("size")).when(cut, rest).otherwise(F.lit(0))
    d = d.withColumn("taken", (F.col("_whole") * F.col("size") + rest).cast("long"))
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(F.lit(0.0))
    return d.select("doc_id", "source", "size", "source_size", "target", "taken", copies.alias("copies"), "_h")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it, with all its columns.

    Repetitions are whole documents here. Documents without a word weigh nothing and are kept
    once. Rows with equal doc_id, source and text share what the mix takes of them evenly.
    """
    each = F.when(F.col("size") == 0, 1).otherwise(F.round("copies")).cast("long")
    plan = _plan(docs, weights, max_epochs, seed, True).groupBy(F.struct("doc_id", "source", "_h").alias("row")).agg(F.sum(each).alias("copies"), F.count("*").alias("rows"))
    # The documents' columns travel as one, so that none clashes.
    keyed = docs.select(F.struct("*").alias("doc"), F.struct("doc_id", "source", F.xxhash64("text").alias("_h")).alias("key"))
    out = keyed.join(plan, F.col("key") == F.col("row"))
    # Copies left over by even shares go to the first of the equal rows.
    nth = F.row_number().over(Window.partitionBy("row").orderBy("row"))
    times = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("rows") > 1, (nth <= F.col("copies") % F.col("rows")).cast("int")).otherwise(0)
    out = out.withColumn("times", times.cast("int")).where("times > 0")
    return out.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("copy")).select("doc.*")


def mix_digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return mix(docs).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "source")
