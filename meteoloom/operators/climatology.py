"""Day-of-year climatologies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import doy_to_mmdd

YEAR = 366


def doy_means(hindcast: DataFrame, keys=("model", "var", "lead_ix", "lat", "lon")) -> DataFrame:
    """A2: per start the mean over sub-daily starts, then over members, then over starts of one
    day of the year; each mean is unweighted and skips missing values (Q8). Adds doy, value.

    The raw day of the year is used, so starts after February move by one day in leap years (Q3).
    """
    keys = list(keys)
    by_member = hindcast.groupBy(*keys, "init_date", "member").agg(F.avg("value").alias("value"))
    by_start = by_member.groupBy(*keys, "init_date").agg(F.avg("value").alias("value"))
    return by_start.groupBy(*keys, F.dayofyear("init_date").alias("doy")).agg(F.avg("value").alias("value"))


def fill_year(means: DataFrame, keys=("model", "var", "lead_ix", "lat", "lon")) -> DataFrame:
    """A2: all 366 days for every key; days without a start are null. Keeps a partitioning by keys."""
    keys = list(keys)
    year = means.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("doy", "value"))).alias("_year"))
    days = year.select(*keys, "_year", F.explode(F.sequence(F.lit(1), F.lit(YEAR))).alias("doy"))
    return days.select(*keys, "doy", F.try_element_at("_year", F.col("doy")).alias("value"))


def circular_smooth(df: DataFrame, window: int = 31, passes: int = 2, keys=("model", "var", "lead_ix", "lat", "lon")) -> DataFrame:
    """``passes`` centred means of ``window`` days around the year, one after the other.

    Missing days are skipped, and a window without a value stays missing. The year's ends are
    padded anew in each pass; two passes can't be folded into one weighted window where days
    are missing. All passes use the partitioning by keys.
    """
    half = window // 2
    keys = list(keys)
    for _ in range(passes):
        shifts = F.array(F.lit(0), F.when(F.col("doy") > YEAR - half, F.lit(-YEAR)), F.when(F.col("doy") <= half, F.lit(YEAR)))
        padded = df.withColumn("_shift", F.explode(F.array_compact(shifts))).withColumn("_at", F.col("doy") + F.col("_shift"))
        w = Window.partitionBy(*keys).orderBy("_at").rangeBetween(-half, half)
        df = padded.withColumn("value", F.avg("value").over(w)).where("_shift = 0").select(*keys, "doy", "value")
    return df


def climatology(hindcast: DataFrame, first: int | None = None, last: int | None = None, window: int = 31, passes: int = 2, keys=("model", "var", "lead_ix", "lat", "lon")) -> DataFrame:
    """A2 then W1 over a year range: keys, doy, mmdd, value.

    The hindcast is shuffled once, by a hash of its keys that all means and both smoothing passes
    carry along. (Spark normalises floating-point keys of windows, and so wouldn't see that a
    partitioning by the keys themselves is good for both.)
    """
    keys = list(keys)
    if first is not None:
        hindcast = hindcast.where(F.year("init_date") >= first)
    if last is not None:
        hindcast = hindcast.where(F.year("init_date") <= last)
    dealt = hindcast.select(F.xxhash64(*keys).alias("_series"), *keys, "init_date", "member", "value").repartition("_series")
    own = ["_series", *keys]
    smooth = circular_smooth(fill_year(doy_means(dealt, own), own), window, passes, own).drop("_series")
    return smooth.withColumn("mmdd", doy_to_mmdd(F.col("doy")))
