"""The driver's tables seen as forecast data, for Spark and as SQL common table expressions.

``cube``: six models and more as the tables grow, two variables, members, 45 leads, eight cells;
some keys are missing.
``climo``: mean of each lead and cell. ``hind``: a hindcast by order date. ``cat``: a catalog
of files, one for each order's (priority, customer class, date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FCST = "2026-03-05"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _place(cell):
    return (F.floor(cell / 4) * 10.0).alias("lat"), (F.pmod(cell, F.lit(4)) * 90.0).alias("lon")


_VARS = (("pr", 0.0), ("tas", 250.0))


def _by_var(df: DataFrame, value) -> DataFrame:
    rows = F.inline(F.array(*[F.struct(F.lit(v).alias("var"), (value + F.lit(o)).alias("value")) for v, o in _VARS]))
    return df.select("*", rows)


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems with base (six of them), model, lead_ix and cell.

    A base has one model for each hundred suppliers, so that the number of models grows with the
    tables and a model's cube stays as full as it is.
    """
    many = table(spark, sf_dir, "supplier").agg(F.greatest(F.lit(1), F.floor(F.count("*") / 100)).alias("_many"))
    li = table(spark, sf_dir, "lineitem").crossJoin(F.broadcast(many))  # one row
    group = F.pmod(F.floor(F.col("l_suppkey") / 8), F.col("_many"))
    base = F.concat_ws("-", "l_returnflag", "l_linestatus")
    return li.select(
        base.alias("base"), F.concat(base, F.when(group > 0, group.cast("string")).otherwise("")).alias("model"), F.col("l_linenumber").cast("int").alias("member"),
        F.pmod(F.col("l_partkey"), F.lit(45)).cast("int").alias("lead_ix"), F.pmod(F.col("l_suppkey"), F.lit(8)).cast("int").alias("cell"), "l_quantity",
    )


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, var, init_date, member, lead_ix, valid_date, lat, lon, value."""
    li = _models(spark, sf_dir)
    fx = li.groupBy("base", "model", "member", "lead_ix", "cell").agg(F.sum("l_quantity").cast("double").alias("q"))
    bases = li.select(F.col("base").alias("_base")).distinct().withColumn("_r", F.row_number().over(Window.orderBy("_base")))  # six
    fx = fx.join(F.broadcast(bases), F.col("base") == F.col("_base")).withColumn("init_date", F.date_sub(F.lit(FCST).cast("date"), F.col("_r")))
    fx = fx.withColumn("valid_date", F.date_add("init_date", F.col("lead_ix")))
    return _by_var(fx.select("model", "init_date", "member", "lead_ix", "valid_date", *_place(F.col("cell")), "q"), F.col("q")).select("model", "var", "init_date", "member", "lead_ix", "valid_date", "lat", "lon", "value")


def climo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, var, lead_ix, lat, lon, value."""
    mean = _models(spark, sf_dir).groupBy("model", "lead_ix", "cell").agg(F.avg("l_quantity").cast("double").alias("q"))
    return _by_var(mean.select("model", "lead_ix", *_place(F.col("cell")), "q"), F.col("q")).select("model", "var", "lead_ix", "lat", "lon", "value")


def hindcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, var, init_date, member, lead_ix, lat, lon, value."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(
        F.col("l_returnflag").alias("model"), F.lit("pr").alias("var"), F.col("o_orderdate").cast("date").alias("init_date"), F.col("l_linenumber").cast("int").alias("member"),
        F.pmod(F.col("l_partkey"), F.lit(5)).cast("int").alias("lead_ix"), F.lit(0.0).alias("lat"), (F.pmod(F.col("l_suppkey"), F.lit(4)) * 90.0).alias("lon"), F.col("l_quantity").cast("double").alias("value"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """var, model, init_date, path: distinct files."""
    o = table(spark, sf_dir, "orders")
    var = F.concat(F.lit("v"), F.substring("o_orderpriority", 1, 1))
    model = F.concat(F.lit("G-M"), F.pmod(F.col("o_custkey"), F.lit(6)).cast("string"))
    files = o.select(var.alias("var"), model.alias("model"), F.col("o_orderdate").cast("date").alias("init_date")).distinct()
    name = F.concat(F.lit("/data/forecast/"), F.col("var"), F.lit("/"), F.col("var"), F.lit("_"), F.col("model"), F.lit("_"), F.date_format("init_date", "yyyyMMdd"), F.lit(".daily.nc"))
    return files.withColumn("path", name)


CUBE = f"""many AS (SELECT GREATEST(1, COUNT(*) // 100) AS k FROM supplier),
li AS (SELECT l_returnflag || '-' || l_linestatus AS base, l_returnflag || '-' || l_linestatus || CASE WHEN l_suppkey // 8 % k = 0 THEN '' ELSE CAST(l_suppkey // 8 % k AS VARCHAR) END AS model,
  CAST(l_linenumber AS INT) AS member, CAST(l_partkey % 45 AS INT) AS lead_ix, CAST(l_suppkey % 8 AS INT) AS cell, l_quantity FROM lineitem CROSS JOIN many),
fx AS (SELECT base, model, member, lead_ix, cell, CAST(SUM(l_quantity) AS DOUBLE) AS q FROM li GROUP BY 1, 2, 3, 4, 5),
mdl AS (SELECT base, CAST(ROW_NUMBER() OVER (ORDER BY base) AS INT) AS r FROM (SELECT DISTINCT base FROM fx)),
vars AS (SELECT * FROM (VALUES ('pr', 0.0::DOUBLE), ('tas', 250.0::DOUBLE)) t(var, o)),
cube AS (SELECT model, var, DATE '{FCST}' - r AS init_date, member, lead_ix, DATE '{FCST}' - r + lead_ix AS valid_date,
  (cell // 4) * 10.0::DOUBLE AS lat, (cell % 4) * 90.0::DOUBLE AS lon, q + o AS value FROM fx JOIN mdl USING (base) CROSS JOIN vars)"""
CLIMO = """climo AS (SELECT model, var, lead_ix, (cell // 4) * 10.0::DOUBLE AS lat, (cell % 4) * 90.0::DOUBLE AS lon, AVG(l_quantity) + o AS value
  FROM li CROSS JOIN vars GROUP BY 1, 2, 3, 4, 5, o)"""
HIND = """hind AS (SELECT l_returnflag AS model, 'pr' AS var, CAST(o_orderdate AS DATE) AS init_date, CAST(l_linenumber AS INT) AS member,
  CAST(l_partkey % 5 AS INT) AS lead_ix, 0.0::DOUBLE AS lat, (l_suppkey % 4) * 90.0::DOUBLE AS lon, CAST(l_quantity AS DOUBLE) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
CAT = """cat AS (SELECT DISTINCT 'v' || substr(o_orderpriority, 1, 1) AS var, 'G-M' || CAST(o_custkey % 6 AS VARCHAR) AS model, CAST(o_orderdate AS DATE) AS init_date FROM orders),
files AS (SELECT *, '/data/forecast/' || var || '/' || var || '_' || model || '_' || strftime(init_date, '%Y%m%d') || '.daily.nc' AS path FROM cat)"""
