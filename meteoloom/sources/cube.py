"""Readers of forecast and hindcast cubes.

A cube is a long table, one row for each cell: kind, model, var, init_date (partition columns),
init_ts, member, lead_ix, lead_days, valid_date, level, lat, lon, value. Missing values are null,
never NaN: NaN would beat every number in comparisons and poison means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import path_fields
from .working import scratch

SCHEMA = (
    "kind string, model string, var string, init_date date, init_ts timestamp_ntz, member int, lead_ix int, "
    "lead_days float, valid_date date, level int, lat double, lon double, value double"
)


def missing_to_null(df: DataFrame, *cols: str) -> DataFrame:
    """NaN to null at the boundary, for ``value`` if no columns are named."""
    return df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols or ("value",)})


def read_cube(spark: SparkSession, root: str, kind: str | None = None, models=None, variables=None, fmt: str = "parquet") -> DataFrame:
    """Cells of a cube stored by partition; the filters prune partitions before any file is read."""
    df = spark.read.schema(SCHEMA).format(fmt).load(root)
    if kind:
        df = df.where(F.col("kind") == kind)
    if models:
        df = df.where(F.col("model").isin(list(models)))
    if variables:
        df = df.where(F.col("var").isin(list(variables)))
    return missing_to_null(df)


def read_provider(spark: SparkSession, root: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Cells of files that are named var_GROUP-MODEL_date, under any folders, with the fields of the names as columns.

    ``schema`` lists the columns inside the files. The fields come from the file's path, so Spark applies filters on
    kind, var, group, model and init_date to the listing, and files that they leave out are neither opened nor planned.
    Files whose name has another form have null fields.
    """
    cells = spark.read.schema(schema).format(fmt).option("recursiveFileLookup", "true").load(root)
    return cells.select(*[e.alias(c) for c, e in path_fields(F.col("_metadata.file_path")).items()], *cells.columns)


FILE = ("kind", "model", "var", "init_date")


def footer_counts(spark: SparkSession, root: str) -> DataFrame:
    """FILE, cells and filled (values) of each partition of a stored cube, from Parquet footers alone.

    A NaN counts as a value; ``write_cube`` stores none.
    """
    path = scratch(spark, "footers")
    counts = count_in_footers(spark, root)
    counts.write.parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def count_in_footers(spark: SparkSession, root: str) -> DataFrame:
    """The scan of ``footer_counts``: counts by partition column are pushed into it, in a session of its own, as that is a setting for whole sessions."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(SCHEMA).parquet(root).groupBy(*FILE).agg(F.count("*").alias("cells"), F.count("value").alias("filled"))


def read_filled(spark: SparkSession, root: str, keys=FILE) -> DataFrame:
    """F1, F2 on a stored cube: its cells without the files (keys) that hold no value, judged by the footers.

    No pass over the cells is needed to find out: partitions without any value go, those without any gap stay. With
    keys finer than a partition (a level, say) only partitions with some values and some gaps are counted by their cells.
    Keys coarser than a partition (without one of FILE) add up their partitions' counts; keys without any of FILE are judged by all cells.
    """
    from ..operators.normalise import join_null_safe
    from ..operators.quality import drop_empty

    cells = read_cube(spark, root)
    coarse = [k for k in FILE if k in keys]
    if not coarse:
        return drop_empty(cells, list(keys))
    counts = footer_counts(spark, root)
    total = counts.groupBy(*coarse).agg(F.sum("cells").alias("cells"), F.sum("filled").alias("filled"))
    if set(keys) <= set(FILE):
        return join_null_safe(cells, total.where("filled > 0").select(*coarse), coarse, "left_semi")
    whole, torn = (total.where(w).select(*coarse) for w in ("filled = cells", "filled > 0 AND filled < cells"))
    return join_null_safe(cells, whole, coarse, "left_semi").unionByName(drop_empty(join_null_safe(cells, torn, coarse, "left_semi"), list(keys)))


def read_hindcast(spark: SparkSession, root: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """All starts of the hindcast in a year range (whole archive where unset), without all-missing starts."""
    from ..operators.quality import drop_empty

    df = read_cube(spark, root, "hindcast")
    if first is not None:
        df = df.where(F.year("init_date") >= first)
    if last is not None:
        df = df.where(F.year("init_date") <= last)
    return drop_empty(df, ["model", "var", "level", "init_date"])


def add_ensemble_means(cube: DataFrame, means: DataFrame) -> DataFrame:
    """S3: join an ensemble-mean source to a hindcast. It has no members, and its lead is a position in time."""
    from ..operators.normalise import lead_position

    means = lead_position(means.withColumn("member", F.lit(None).cast("int")))
    return cube.unionByName(means, allowMissingColumns=True)


def cube_profile(cube: DataFrame, keys=("model", "var")) -> DataFrame:
    """Size of each dimension and the sorted start times, for each key."""
    n = lambda c: F.countDistinct(c).alias(f"n_{c}")
    return cube.groupBy(*keys).agg(*map(n, ("member", "lead_ix", "level", "lat", "lon")), F.array_sort(F.collect_set("init_date")).alias("starts"))


def write_cube(cube: DataFrame, root: str, mode: str = "append") -> None:
    """Cells by partition, rows of a file by place and lead so that row groups can be skipped. NaN is stored as null."""
    parts = list(FILE)
    ordered = missing_to_null(cube).repartition(*parts).sortWithinPartitions(*parts, "lat", "lon", "lead_ix")
    ordered.write.mode(mode).partitionBy(*parts).parquet(root)
