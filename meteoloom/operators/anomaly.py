"""Ensemble means, anomalies and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ensemble_mean(df: DataFrame, drop=("member", "init_ts")) -> DataFrame:
    """A1: mean over members, missing values skipped."""
    keys = [c for c in df.columns if c not in (*drop, "value")]
    return df.groupBy(*keys).agg(F.avg("value").alias("value"))


def ensemble_size(df: DataFrame) -> DataFrame:
    """A10: members of each model: the most that any of its variables has."""
    return df.groupBy("model", "var").agg(F.countDistinct("member").alias("n")).groupBy("model").agg(F.max("n").alias("nens"))


def first_available(climo: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of the first candidate name of each model that exists. ``candidates``: model, name, cand_ix."""
    have = climo.select(F.col("model").alias("name")).distinct()
    w = Window.partitionBy("model").orderBy("cand_ix", "name")
    best = candidates.join(have, "name", "left_semi").withColumn("_n", F.row_number().over(w)).where("_n = 1").select("model", "name")
    return climo.withColumnRenamed("model", "name").join(best, "name").drop("name")


def anomaly(forecast: DataFrame, climo: DataFrame, align: str = "position", per_member: bool = False) -> DataFrame:
    """J1 (ensemble mean), J2 (each member), J3 (align='date'): forecast minus climatology.

    By position both sides are trimmed to the leads that they have in common; by date the
    climatology's valid_date is matched, for sources whose climatology starts another day.
    ``climo``: model, var, lead_ix or valid_date, lat, lon, value, for one month-day.
    """
    if not per_member:
        forecast = ensemble_mean(forecast)
    by = "lead_ix" if align == "position" else "valid_date"
    keys = ["model", "var", by, "lat", "lon"]
    normal = climo.select(*keys, F.col("value").alias("_normal"))
    # An inner join on positions is the trim: both count from 0 without gaps.
    out = forecast.join(normal, keys).withColumn("value", F.col("value") - F.col("_normal"))
    return out.select(*forecast.columns)


def climo_valid_dates(climo: DataFrame, first_valid: DataFrame) -> DataFrame:
    """Valid dates of a climatology that starts one day before the forecast's first (model, first_valid)."""
    return climo.join(F.broadcast(first_valid), "model").withColumn("valid_date", F.date_add("first_valid", F.col("lead_ix") - 1)).drop("first_valid", "lead_ix")


def enrich_runs(df: DataFrame, runs: DataFrame, fcst: str, mme: str = "SUBC-MME") -> DataFrame:
    """Start date and ensemble size of each model; the multi-model mean gets fcst and their sum.

    ``runs``: model, init_date, nens, one row for each model.
    """
    own = runs.select("model", "init_date", "nens")
    total = own.agg(F.sum("nens").alias("nens")).select(F.lit(mme).alias("model"), F.lit(fcst).cast("date").alias("init_date"), "nens")
    return df.drop("init_date", "nens").join(F.broadcast(own.unionByName(total)), "model", "left")
