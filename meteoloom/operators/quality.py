"""Filters on missing, implausible and repeated data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.selection import exact_quantiles
from .normalise import join_null_safe


def drop_empty(df: DataFrame, keys, sample: str | None = None, level: float | None = None) -> DataFrame:
    """drop the files (keys) without any value, judged on all cells or on a sample.

    ``sample`` is ``centre`` (five by five cells around the middle of the grid), ``strided`` (about ten by ten, evenly from the
    first on) or ``plane`` (all cells; a file stays if any start has a value). Positions are counted on the file's own axes, so a
    regional grid has its own middle. All are taken at the first member and lead and one level: the one nearest to ``level``,
    else the first; the first two also at the first start. A file whose sample has no row is kept.
    """
    if sample is None:
        good = df.groupBy(*keys).agg(F.count("value").alias("_n")).where("_n > 0").drop("_n")
        return join_null_safe(df, good, keys, "left_semi")
    seen = sampled_cells(df, keys, sample, level)
    bad = seen.groupBy(*keys).agg(F.count("value").alias("_n")).where("_n = 0").drop("_n")
    return join_null_safe(df, bad, keys, "left_anti")


def sampled_cells(df: DataFrame, keys, sample: str, level: float | None = None) -> DataFrame:
    """the cells of each file that the sample names, found by position on the file's own axes.

    The axes of a file, its distinct labels, are gathered first: one row for each file.
    """
    if sample not in ("centre", "strided", "plane"):
        raise ValueError(f"no such sample: {sample}")
    firsts = [c for c in ("init_ts", "member", "lead_ix") if c in df.columns and c not in keys and (sample != "plane" or c != "init_ts")]
    axis = lambda c: F.array_sort(F.collect_set(c))
    wanted = [axis("lat").alias("_lats"), axis("lon").alias("_lons"), *[F.min(c).alias(f"_first_{c}") for c in firsts]]
    if "level" in df.columns and "level" not in keys:
        wanted.append((F.min("level") if level is None else F.min_by("level", F.struct(F.abs(F.col("level") - level), "level"))).alias("_first_level"))
        firsts = [*firsts, "level"]

    def part(axis: str):
        at, every = F.col(axis), F.greatest(F.lit(1), F.floor(F.size(axis) / 10).cast("int"))
        if sample == "centre":
            middle = F.floor(F.size(at) / 2).cast("int")
            return F.slice(at, F.greatest(F.lit(1), middle - 1), F.least(F.lit(5), middle + 3))
        return at if sample == "plane" else F.filter(at, lambda x, i: i % every == 0)

    axes = df.groupBy(*keys).agg(*wanted).withColumns({"_lats": part("_lats"), "_lons": part("_lons")})
    near = join_null_safe(df, axes, keys)
    inside = F.array_contains("_lats", F.col("lat")) & F.array_contains("_lons", F.col("lon"))
    for c in firsts:
        inside = inside & F.col(c).eqNullSafe(F.col(f"_first_{c}"))
    return near.where(inside).select(*df.columns)


def plausible_median(df: DataFrame, var: str = "tas", low: float = 180, high: float = 330) -> DataFrame:
    """drop (model, var) whose median is outside [low, high] (or missing); other variables stay.

    The median of a model is selected over passes, so no task holds all its cells. Apply it to ensemble means. Member anomalies are made before this guard (Q4).
    """
    medians = exact_quantiles(df.where(F.col("var") == var), ["model"], (0.5,)).select(F.col("model").alias("_m"), F.col("q")[0].alias("_median"))
    good = medians.where(F.col("_median").between(low, high))
    kept = df.where(F.col("var") == var).join(good, F.col("model") == F.col("_m"), "left_semi")
    return df.where(~F.col("var").eqNullSafe(F.lit(var))).unionByName(kept)


def trim_empty_leads(df: DataFrame, keys=("model", "var"), restart: bool = False) -> DataFrame:
    """drop leading and trailing leads without any value; gaps between stay.

    Positions are kept, or with ``restart`` counted from 0 at the first lead that is left.
    """
    b = df.where(F.col("value").isNotNull()).groupBy(*keys).agg(F.min("lead_ix").alias("_lo"), F.max("lead_ix").alias("_hi"))
    out = df.join(F.broadcast(b), list(keys)).where(F.col("lead_ix").between(F.col("_lo"), F.col("_hi")))  # a row for each series
    if restart:
        out = out.withColumn("lead_ix", F.col("lead_ix") - F.col("_lo"))
    return out.select(*df.columns)


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """the first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
