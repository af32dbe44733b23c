"""Sinks: products, manifests and threshold sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "entry string, stage string, first_year int, last_year int, entries array<string>, written timestamp, _corrupt_record string"


def write_product(df: DataFrame, root: str, fcst: str, mode: str = "append") -> None:
    """A weekly product by forecast date; rows of a file by model and week."""
    out = df.withColumn("fcst_date", F.lit(fcst).cast("date"))
    out.sortWithinPartitions("model", "week").write.mode(mode).partitionBy("fcst_date").parquet(root)


def product_attributes(main: DataFrame, members: DataFrame) -> DataFrame:
    """One row that lists the variables of the mean and of the member product."""
    a = main.agg(F.array_sort(F.collect_set("var")).alias("mean_variables"))
    b = members.agg(F.array_sort(F.collect_set("var")).alias("member_variables"))
    return a.crossJoin(b)


def write_region_weekly(df: DataFrame, root: str) -> None:
    """Weekly values by region and week, with their unit and aggregation as columns."""
    pr = F.col("var").startswith("pr")
    out = df.withColumns({"units": F.when(pr & (F.col("week") == 34), "mm/2-weeks").when(pr, "mm/week").otherwise("native"), "aggregation": F.when(pr, "sum").otherwise("mean")})
    out.write.mode("overwrite").partitionBy("region", "week").parquet(root)


def append_manifest(df: DataFrame, path: str) -> None:
    """Append JSON lines."""
    df.write.mode("append").json(path)


def read_manifest(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """Manifest rows; lines that aren't valid JSON are skipped."""
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return rows.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record") if "_corrupt_record" in rows.columns else rows


def write_thresholds(df: DataFrame, root: str) -> None:
    """Thresholds by month-day; only partitions that the rows name are written."""
    df.repartition("mmdd").write.mode("append").partitionBy("mmdd").parquet(root)
