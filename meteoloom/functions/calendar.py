"""Dates, weeks and days of the year as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_thursday(day: Column) -> Column:
    """The Thursday on or before ``day``."""
    return F.date_sub(day, F.pmod(F.weekday(day) - 3, F.lit(7)))


def forecast_week(day: Column) -> Column:
    """The seven dates that end at ``day``."""
    return F.sequence(F.date_sub(day, 6), day)


def month_start(day: Column) -> Column:
    """D3."""
    return F.trunc(day, "MM")


def week_dim(spark: SparkSession, fcst: str, weeks: int = 4) -> DataFrame:
    """Week, week_start, week_end; week i (from 1) is the seven days from fcst + 2 + 7(i-1)."""
    first = F.date_add(F.lit(fcst).cast("date"), 2)
    w = spark.range(1, weeks + 1).select(F.col("id").cast("int").alias("week"))
    start = F.date_add(first, (F.col("week") - 1) * 7)
    return w.select("week", start.alias("week_start"), F.date_add(start, 6).alias("week_end"))


def doy_to_mmdd(doy: Column) -> Column:
    """D5 for climatologies: day of year to MMDD in a leap year, so day 60 is 0229 in any year (Q3)."""
    return F.date_format(F.date_add(F.lit("1959-12-31").cast("date"), doy.cast("int")), "MMdd")


def mmdd_to_doy(mmdd: Column) -> Column:
    """D5 for thresholds: MMDD to day of year in leap year 2000; null for a bad label."""
    return F.dayofyear(F.try_to_date(F.concat(F.lit("2000"), mmdd), "yyyyMMdd"))


def mmdd(day: Column) -> Column:
    return F.date_format(day, "MMdd")


def circular_days(a: Column, b: Column, year: int = 366) -> Column:
    """Distance of two days of the year around its end."""
    d = F.abs(a - b)
    return F.least(d, F.lit(year) - d)


def parse_date_token(name: Column) -> Column:
    """The first valid date among 20YYMMDD tokens, else a ddmonyyyy token; null if there is none."""
    digits = F.transform(F.regexp_extract_all(name, F.lit(r"(20\d{6})"), 1), lambda t: F.try_to_date(t, "yyyyMMdd"))
    named = F.transform(F.regexp_extract_all(F.lower(name), F.lit(r"(\d{2}[a-z]{3}\d{4})"), 1), lambda t: F.try_to_date(F.initcap(t), "ddMMMyyyy"))
    valid = F.filter(F.concat(digits, named), lambda d: d.isNotNull())
    return F.try_element_at(valid, F.lit(1))


def sub_daily_start(day: Column, label: Column) -> Column:
    """Date and 'HHz' to a timestamp."""
    hours = F.regexp_extract(label, r"(\d{1,2})z", 1)
    return F.timestamp_add("HOUR", hours.cast("int"), day.cast("timestamp_ntz"))
