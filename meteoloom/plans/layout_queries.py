"""Queries over layouts that spare work: labels laid over stored cells, footers, file names, buckets, words of bits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import bitsets
from ..operators import archive as ar
from ..operators import validation as va
from ..sources import catalog as ct
from ..sources import cube as cu
from ..sources import references as rf
from ..sources.snapshots import Archive
from ..sources.working import scratch, store
from .archive_queries import _FILES, _member_files, DAY
from .fixtures import CAT, CLIMO, CUBE, HIND, catalog, climo, cube, hindcast, table
from .stored_queries import _full

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return keep


@query(f"""WITH {CUBE}, v AS (SELECT UNNEST([1, 2, 3, 4]) AS version), l AS (SELECT version, model, var, lead_ix, value, CASE WHEN model LIKE 'A%' THEN lead_ix + 0.25 ELSE lead_ix END AS stored,
CASE WHEN version IN (1, 4) THEN 0 WHEN model LIKE 'N%' AND version = 3 THEN 1 + lead_ix WHEN model LIKE 'A%' THEN 0 ELSE 0.5 END AS plus FROM cube CROSS JOIN v)
SELECT CAST(version AS INT) AS version, model, var, COUNT(*) AS cells, SUM(value) AS total, MIN(stored + plus)::DOUBLE AS first_lead, MAX(stored + plus)::DOUBLE AS last_lead, 0 AS files_written FROM l GROUP BY 1, 2, 3""")
def overlaid_leads(spark, sf_dir):
    """Labels laid over an archive. Version 1 as stored, 2 moved by half a day where they are whole
    numbers, 3 on their own grid for some models, 4 rolled back to the first; the files are those of version 1."""
    root = scratch(spark, "archive")
    c = _full(cube(spark, sf_dir), "forecast")
    whole = store(c.withColumn("lead_days", (F.col("lead_ix") + F.when(F.col("model").startswith("A"), 0.25).otherwise(0)).cast("float")), "leads")
    archive = Archive(spark, root)
    archive.commit(0, archive.stage(whole)[1])
    ar.overlay_leads(spark, root, c.schema, ar.shifted_labels())
    grid = whole.where("model LIKE 'N%'").groupBy("model", "var").agg((F.max("lead_ix") + 1).alias("n")).groupBy("model").agg(F.max("n").alias("n"))
    ar.overlay_leads(spark, root, c.schema, ar.grid_labels(grid.select("model", F.lit(1.0).alias("first"), (2.0 * F.col("n") - 1).alias("last"), "n")))
    archive.roll_back(1)
    first = archive.files(1).select("path")
    out = None
    for v in range(1, 5):
        fresh = archive.files(v).select("path").join(first, "path", "left_anti").agg(F.count("*").cast("int").alias("files_written"))
        label = F.col("lead_days").cast("double")
        seen = archive.read(c.schema, v).groupBy("model", "var").agg(F.count("*").alias("cells"), F.sum("value").alias("total"), F.min(label).alias("first_lead"), F.max(label).alias("last_lead"))
        part = seen.crossJoin(F.broadcast(fresh)).withColumn("version", F.lit(v))  # one row
        out = part if out is None else out.unionByName(part)
    return out.select("version", "model", "var", "cells", "total", "first_lead", "last_lead", "files_written")


@query("""SELECT 'v' || substr(o_orderpriority, 1, 1) AS var, 'G-M' || CAST(o_custkey % 6 AS VARCHAR) AS model, CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) AS init_date, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders
WHERE substr(o_orderpriority, 1, 1) = '2' AND o_custkey % 6 = 3 AND CAST(o_orderdate AS DATE) >= DATE '1997-01-01' GROUP BY 1, 2, 3""")
def provider_files(spark, sf_dir):
    """A folder of files named by variable, model and start; filters on these choose the files."""
    root = scratch(spark, "provider")
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("v"), F.substring("o_orderpriority", 1, 1)).alias("var"), F.concat(F.lit("G-M"), F.pmod("o_custkey", F.lit(6)).cast("string")).alias("model"),
                                              F.trunc("o_orderdate", "year").alias("init_date"), F.col("o_totalprice").cast("double").alias("value"))
    name_files(o, root)
    got = cu.read_provider(spark, root, "value double").where("var = 'v2' AND model = 'G-M3' AND init_date >= DATE '1997-01-01'")
    return got.groupBy("var", "model", "init_date").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def name_files(cells, root: str) -> None:
    """Files named var_model_date.daily.nc.parquet in a folder for each variable, as a provider delivers them: written by partition, then renamed."""
    spark = cells.sparkSession
    made = scratch(spark, "named")
    name = F.concat_ws("_", "var", "model", F.concat(F.date_format("init_date", "yyyyMMdd"), F.lit(".daily.nc")))
    cells.withColumns({"_var": F.col("var"), "_name": name}).select("value", "_var", "_name").repartition("_var", "_name").write.partitionBy("_var", "_name").parquet(made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    for var in fs.listStatus(path(made)):
        if not var.isDirectory():
            continue
        to = f"{root}/forecast/{var.getPath().getName().removeprefix('_var=')}"
        fs.mkdirs(path(to))
        for folder in fs.listStatus(var.getPath()):
            for i, file in enumerate(f for f in fs.listStatus(folder.getPath()) if f.getPath().getName().endswith(".parquet")):
                fs.rename(file.getPath(), path(f"{to}/{folder.getPath().getName().removeprefix('_name=')}{f'.{i}' if i else ''}.parquet"))


@query(f"""WITH {HIND}, h AS (SELECT model, CAST(date_trunc('month', init_date) AS DATE) AS init_date, lon, CASE WHEN extract(month FROM init_date) = 5 OR (extract(month FROM init_date) = 6 AND lon = 90) THEN NULL ELSE value END AS value FROM hind)
SELECT model, init_date, COUNT(*) AS n, COUNT(value) AS filled, SUM(value) AS total, COUNT(DISTINCT lon) AS lons FROM h WHERE (model, init_date, lon) IN (SELECT model, init_date, lon FROM h GROUP BY 1, 2, 3 HAVING COUNT(value) > 0) GROUP BY 1, 2""")
def filled_files(spark, sf_dir):
    """F1, F2 by Parquet footers: starts of May hold nothing, those of June nothing at one level."""
    root = scratch(spark, "hindcast")
    h = hindcast(spark, sf_dir).withColumn("init_date", F.trunc("init_date", "month"))
    lost = (F.month("init_date") == 5) | ((F.month("init_date") == 6) & (F.col("lon") == 90))
    full = _full(h.withColumn("value", F.when(~lost, F.col("value"))), "hindcast").withColumn("level", F.col("lon").cast("int"))
    cu.write_cube(full, root)
    got = cu.read_filled(spark, root, ["model", "var", "init_date", "level"])
    return got.groupBy("model", "init_date").agg(F.count("*").alias("n"), F.count("value").alias("filled"), F.sum("value").alias("total"), F.countDistinct("lon").alias("lons"))


def _reference(spark, sf_dir, **more) -> str:
    """The climatology as a bucketed table, by kind of threshold."""
    name = f"reference_{uuid.uuid4().hex}"
    each = climo(spark, sf_dir).crossJoin(F.broadcast(spark.createDataFrame([("mean", 0.0), ("p90", 4.0)], "stat string, plus double")))  # two rows
    rf.store_reference(each.withColumn("value", F.col("value") + F.col("plus")).drop("plus"), name, 8, by=["stat"], path=scratch(spark, "reference"))
    return name


@query(f"""WITH {CUBE}, {CLIMO}, mean AS (SELECT model, var, lead_ix, lat, lon, AVG(value) AS value FROM cube GROUP BY ALL)
SELECT m.model, m.var, m.lead_ix, COUNT(*) AS n, ROUND(SUM(m.value - c.value), 3) AS total FROM mean m JOIN climo c USING (model, var, lead_ix, lat, lon) GROUP BY 1, 2, 3""")
def anomaly_in_place(spark, sf_dir):
    """J1 against a climatology stored in buckets."""
    a = rf.anomaly_in_place(cube(spark, sf_dir), _reference(spark, sf_dir), F.col("stat") == "mean")
    return a.groupBy("model", "var", "lead_ix").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query(f"""WITH {CUBE}, {CLIMO} SELECT f.model, f.var, member, COUNT(*) AS n, SUM(CASE WHEN f.value > c.value + 4 THEN 1 ELSE 0 END) AS crossed FROM cube f JOIN climo c USING (model, var, lead_ix, lat, lon) GROUP BY 1, 2, 3""")
def crossings_in_place(spark, sf_dir):
    """J7 against thresholds stored in buckets."""
    x = rf.crossings_in_place(cube(spark, sf_dir), _reference(spark, sf_dir), F.col("stat") == "p90")
    return x.groupBy("model", "var", "member").agg(F.count("*").alias("n"), F.sum("crossed").alias("crossed"))


@query(f"""WITH {CAT}, lack AS (SELECT model, var, init_date FROM files EXCEPT SELECT model, var, init_date FROM files WHERE model = 'G-M2' AND extract(day FROM init_date) < 15 OR var = 'v3' AND extract(year FROM init_date) < 1996)
SELECT model, var, COUNT(*) AS n, MIN(init_date) AS first, MAX(init_date) AS last FROM lack GROUP BY 1, 2""")
def missing_start_words(spark, sf_dir):
    """S13 by words of starts: what the mirror lacks, how many and from when to when."""
    c = catalog(spark, sf_dir)
    remote = c.where((F.col("model") == "G-M2") & (F.dayofmonth("init_date") < 15) | (F.col("var") == "v3") & (F.year("init_date") < 1996))
    lack = store(ct.missing_starts(ct.start_words(c), ct.start_words(remote)), "missing-starts")
    ends = ct.starts_of(lack).groupBy("model", "var").agg(F.min("init_date").alias("first"), F.max("init_date").alias("last"))
    return bitsets.counts(lack, ["model", "var"]).join(ends, ["model", "var"])


@query(f"""WITH {_FILES}, n AS (SELECT model, init_date, COUNT(DISTINCT var) AS a FROM mem GROUP BY 1, 2), c AS (SELECT m.model, m.init_date, member FROM mem m JOIN n USING (model, init_date) GROUP BY 1, 2, 3, a HAVING COUNT(DISTINCT var) = a AND a = 2)
SELECT DISTINCT model, init_date, member FROM mem EXCEPT SELECT model, init_date, member FROM c""")
def member_words_to_fetch(spark, sf_dir):
    """S12 by words of members."""
    m = _member_files(spark, sf_dir)
    return ct.member_words_to_fetch(m, ct.complete_member_words(m, 2))


@query(f"""WITH {CAT}, n AS (SELECT model, var, MAX(init_date) AS init_date FROM files WHERE init_date BETWEEN DATE '{DAY}' - 2 AND DATE '{DAY}' GROUP BY 1, 2)
SELECT e.model, e.var, init_date, init_date IS NOT NULL AS ok FROM (SELECT DISTINCT model, var FROM files) e LEFT JOIN n USING (model, var)""")
def presence_of_words(spark, sf_dir):
    """V1, S6 by words of starts."""
    words = ct.start_words(catalog(spark, sf_dir))
    return va.presence_of_words(words.select("model", "var").distinct(), words, DAY, 3)
