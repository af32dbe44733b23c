"""Regions and domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def domain_view(df: DataFrame, lon: tuple[float, float], lat: tuple[float, float]) -> DataFrame:
    """Longitudes to -180..180, then an inclusive box, whichever way the axes run."""
    x = F.when(F.col("lon") > 180, F.col("lon") - 360).otherwise(F.col("lon"))
    return df.withColumn("lon", x).where(F.col("lon").between(min(lon), max(lon)) & F.col("lat").between(min(lat), max(lat)))


def in_box(wrap: bool) -> Column:
    """The cell (lat, lon) lies in the row's box west, east, south, north; with ``wrap``, west > east crosses the dateline."""
    lat = F.col("lat").between(F.least("south", "north"), F.greatest("south", "north"))
    plain = F.col("lon").between(F.least("west", "east"), F.greatest("west", "east"))
    if not wrap:
        return lat & plain
    return lat & F.when(F.col("west") > F.col("east"), (F.col("lon") >= F.col("west")) | (F.col("lon") <= F.col("east"))).otherwise(F.col("lon").between(F.col("west"), F.col("east")))


def clip_region(df: DataFrame, regions: DataFrame, wrap: bool = False, most: int = 10_000) -> DataFrame:
    """cells with each region that holds them. ``regions``: region, west, east, south, north.

    The regions are matched to the distinct grid points, not to every cell, and that
    (point, region) list is then an equi-join key. More than ``most`` regions are an error.
    """
    if regions.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} regions")
    points = df.select("lat", "lon").distinct()
    held = points.join(F.broadcast(regions), in_box(wrap)).select("lat", "lon", "region")
    return df.join(held, ["lat", "lon"])


def empty_regions(df: DataFrame, regions: DataFrame, wrap: bool = False) -> DataFrame:
    """regions without any cell (an error for the caller to raise)."""
    return regions.join(clip_region(df, regions, wrap).select("region").distinct(), "region", "left_anti")


def region_weekly(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Weekly values, and those of weeks 3-4 (week 34), for each region."""
    from .weekly import weeks34

    late = weeks34(weekly).withColumn("week", F.lit(34))
    return clip_region(weekly.unionByName(late, allowMissingColumns=True), regions)
