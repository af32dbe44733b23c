"""Climatologies and thresholds as bucketed tables that are joined where they lie.

A row holds a cell's values by lead. Its buckets are those of (model, var, cell), where ``cell`` hashes the place: Spark
normalises floating keys before it compares them, so a bucket by lat and lon themselves would be shuffled again. Places are still
compared exactly. The forecast is dealt once into the same buckets; its mean over members and the join stay there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.anomaly import ensemble_mean

BUCKET = ("model", "var", "cell")


def _cell():
    return F.xxhash64(F.col("lat") + F.lit(0.0), F.col("lon") + F.lit(0.0))


def store_reference(reference: DataFrame, table: str, buckets: int, value: str = "value", by=(), path: str | None = None) -> None:
    """Write a reference (model, var, lead_ix, lat, lon, value) as the bucketed table ``table``, at ``path`` or in the warehouse.

    ``by``: columns that pick a part of it (the climatology's day, the percentile), kept as partitions. Two
    values of a cell at one lead raise; rows without a model, a variable or a place are left out, as they match nothing.
    """
    rows = reference.dropna(subset=["model", "var", "lead_ix", "lat", "lon"]).withColumn("cell", _cell())
    rows = rows.select(*by, *BUCKET, "lat", "lon", F.col("lead_ix").cast("int").alias("lead_ix"), F.col(value).cast("double").alias("_value"))
    dealt = rows.repartition(buckets, *BUCKET)
    packed = dealt.groupBy(*by, *BUCKET, "lat", "lon").agg(F.map_from_entries(F.collect_list(F.struct("lead_ix", "_value"))).alias("of_lead"))
    out = packed.select(*BUCKET, "lat", "lon", "of_lead", *by).write.bucketBy(buckets, *BUCKET).sortBy(*BUCKET)
    if by:
        out = out.partitionBy(*by)
    if path:
        out = out.option("path", path)
    out.saveAsTable(table)


def buckets_of(spark: SparkSession, table: str) -> int:
    """The number of buckets of a table."""
    found = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    if found is None:
        raise ValueError(f"{table} has no buckets")
    return int(found["data_type"])


def join_reference(forecast: DataFrame, table: str, name: str, where=None, mean: bool = False) -> DataFrame:
    """The forecast's rows (with ``mean`` those of its ensemble mean) that the reference has a value for, null included, as column ``name``.

    ``where``: a condition on the reference's ``by`` columns, to leave one row for each cell. The forecast is shuffled once
    (or broadcast, if Spark finds it small enough), the reference never.
    """
    spark = forecast.sparkSession
    dealt = forecast.withColumn("cell", _cell()).repartition(buckets_of(spark, table), *BUCKET)
    if mean:
        dealt = ensemble_mean(dealt)
    held = spark.table(table)
    held = (held if where is None else held.where(where)).select(*[F.col(c).alias(f"_{c}") for c in (*BUCKET, "lat", "lon", "of_lead")])
    on = [F.col(c) == F.col(f"_{c}") for c in BUCKET]
    # Differences, as an equality of places would become one more key of the join.
    near = [F.col(c) - F.col(f"_{c}") == 0 for c in ("lat", "lon")]
    both = dealt.join(held, [*on, *near]).where(F.map_contains_key("_of_lead", F.col("lead_ix").cast("int")))
    columns = [c for c in dealt.columns if c != "cell"]
    return both.select(*columns, F.try_element_at("_of_lead", F.col("lead_ix").cast("int")).alias(name))


def anomaly_in_place(forecast: DataFrame, table: str, where=None, per_member: bool = False) -> DataFrame:
    """J1 (ensemble mean) and J2 (each member) by position, against a stored climatology."""
    both = join_reference(forecast, table, "_normal", where, mean=not per_member)
    return both.withColumn("value", F.col("value") - F.col("_normal")).drop("_normal")


def crossings_in_place(forecast: DataFrame, table: str, where=None, direction: str = "above") -> DataFrame:
    """J7 against stored thresholds: adds ``threshold`` and ``crossed`` (0 or 1). Strict; missing on either side never crosses."""
    if direction not in ("above", "below"):
        raise ValueError(f"direction must be 'above' or 'below', not {direction!r}")
    both = join_reference(forecast, table, "threshold", where)
    cross = F.col("value") > F.col("threshold") if direction == "above" else F.col("value") < F.col("threshold")
    return both.withColumn("crossed", F.coalesce(cross, F.lit(False)).cast("int"))
