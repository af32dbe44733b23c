"""Weekly products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import week_dim
from .normalise import join_null_safe, legacy_model

MME = "SUBC-MME"


def reduce_by_var(empty_sum: str = "zero", value: str = "value"):
    """Sum for variables that start with pr, else mean, of the rows of a group with one var.

    empty_sum='zero': a sum without any value is 0 (Q1), 'null': it is missing.
    """
    s = F.sum(value)
    if empty_sum == "zero":
        s = F.coalesce(s, F.lit(0.0))
    return F.when(F.first("var").startswith("pr"), s).otherwise(F.avg(value))


def weekly_reduce(df: DataFrame, fcst: str, nweeks: int = 4, empty_sum: str = "zero", scale: float = 86400.0) -> DataFrame:
    """A4: weeks 1..n on valid dates: sum of pr x 86400, mean of other variables.

    Every (series, week) has a row: with empty_sum='zero' an uncovered precipitation week is 0,
    any other one is missing.
    """
    keys = [c for c in df.columns if c not in ("valid_date", "lead_ix", "lead_days", "value")]
    weeks = week_dim(df.sparkSession, fcst, nweeks)
    # The week follows from the date alone, so no join with the week table is needed.
    week = (F.floor((F.datediff("valid_date", F.lit(fcst).cast("date")) - 2) / 7) + 1).cast("int")
    v = F.when(F.col("var").startswith("pr"), F.col("value") * scale).otherwise(F.col("value"))
    held = df.withColumn("week", week).where(F.col("week").between(1, nweeks))
    sums = held.groupBy(*keys, "week").agg(F.sum(v).alias("_s"), F.avg(v).alias("_m"))
    spine = df.select(*keys).distinct().crossJoin(F.broadcast(weeks.select("week")))
    total = F.coalesce(F.col("_s"), F.lit(0.0)) if empty_sum == "zero" else F.col("_s")
    return join_null_safe(spine, sums, [*keys, "week"], "left").select(*keys, "week", F.when(F.col("var").startswith("pr"), total).otherwise(F.col("_m")).alias("value"))


def multi_model_mean(df: DataFrame, label: str = MME) -> DataFrame:
    """A5: adds the unweighted mean over models under ``label``, if there is more than one model."""
    keys = [c for c in df.columns if c not in ("model", "value")]
    several = df.agg((F.countDistinct("model") > 1).alias("_several"))  # one row
    mean = df.groupBy(*keys).agg(F.avg("value").alias("value")).crossJoin(F.broadcast(several)).where("_several").drop("_several")
    return df.unionByName(mean.withColumn("model", F.lit(label)))


def weeks34(weekly: DataFrame, empty_sum: str = "zero") -> DataFrame:
    """Weeks 3 and 4 together: sum for pr, else mean."""
    keys = [c for c in weekly.columns if c not in ("week", "value")]
    return weekly.where(F.col("week").isin(3, 4)).groupBy(*keys).agg(reduce_by_var(empty_sum).alias("value"))


def member_stats(df: DataFrame) -> DataFrame:
    """Least, mean and greatest over members."""
    keys = [c for c in df.columns if c not in ("member", "value")]
    return df.groupBy(*keys).agg(F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max"))


def legacy_member_stats(members: DataFrame, fcst: str, models: list[str]) -> DataFrame:
    """Time (a week's last day), lat, lon, and per model its min, mean and max, as columns."""
    stats = member_stats(members.drop("var"))
    weeks = week_dim(members.sparkSession, fcst).select("week", F.col("week_end").alias("time"))
    named = stats.join(F.broadcast(weeks), "week").withColumn("model", legacy_model(F.col("model")))
    return named.groupBy("time", "lat", "lon").pivot("model", models).agg(F.first("min").alias("min"), F.first("mean").alias("mean"), F.first("max").alias("max"))


def weekly_by_position(df: DataFrame, weeks: int = 4, label: str = MME) -> DataFrame:
    """Means of lead positions 0-6, 7-13, ... (a last week may be partial), and over the models that cover a week."""
    keys = [c for c in df.columns if c not in ("lead_ix", "lead_days", "valid_date", "value")]
    week = (F.floor(F.col("lead_ix") / 7) + 1).cast("int")
    own = df.withColumn("week", week).where(F.col("week") <= weeks).groupBy(*keys, "week").agg(F.avg("value").alias("value"))
    return multi_model_mean(own, label)


def shortest_mme(df: DataFrame, label: str = MME) -> DataFrame:
    """The mean over models of every lead, up to the shortest model's last."""
    n = df.groupBy("model").agg(F.max("lead_ix").alias("_n")).agg(F.min("_n").alias("_n"))
    keys = [c for c in df.columns if c not in ("model", "value", "init_date", "valid_date")]
    cut = df.crossJoin(F.broadcast(n)).where(F.col("lead_ix") <= F.col("_n"))
    return cut.groupBy(*keys).agg(F.avg("value").alias("value")).withColumn("model", F.lit(label))


def weekly_total(cube: DataFrame, leads: DataFrame) -> DataFrame:
    """Per start the member mean, then the sum x 86400 over leads in [low + .5, high + .5] days.

    ``leads``: week, low, high (a few rows).
    """
    keys = [c for c in cube.columns if c not in ("member", "init_ts", "value")]
    mean = cube.groupBy(*keys).agg(F.avg("value").alias("value"))
    days = mean.select("lead_days").distinct()
    week_of = days.join(F.broadcast(leads), days["lead_days"].between(leads["low"] + 0.5, leads["high"] + 0.5)).select("lead_days", "week")
    out = mean.join(F.broadcast(week_of), "lead_days")  # a row for each lead and window
    rest = [c for c in keys if c not in ("lead_days", "lead_ix", "valid_date")]
    return out.groupBy(*rest, "week").agg(F.sum(F.col("value") * 86400).alias("value"))


def weekly_obs(daily: DataFrame, fcst: str, leads: DataFrame, days: int = 7) -> DataFrame:
    """Observed sums of each lead window, only where every day of it exists.

    ``daily``: day, lat, lon, value; ``leads``: week, low, high (days after fcst, inclusive).
    """
    spine = leads.select("week", F.explode(F.transform(F.sequence("low", "high"), lambda d: F.date_add(F.lit(fcst).cast("date"), d))).alias("day"))
    got = daily.join(F.broadcast(spine), "day")
    whole = got.select("week", "day").distinct().groupBy("week").agg(F.count("*").alias("_days")).where(F.col("_days") == days)
    return got.join(F.broadcast(whole.select("week")), "week", "left_semi").groupBy("week", "lat", "lon").agg(F.sum("value").alias("value"))
