"""Further queries of normalisation, names, calendars and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as ca
from ..operators import anomaly as an
from ..operators import archive as ar
from ..operators import exceedance as ex
from ..operators import normalise as no
from ..operators import thresholds as th
from ..operators import validation as va
from ..sources import cube as cu
from ..sources import sinks as sk
from .archive_queries import _leads
from .fixtures import CAT, CLIMO, CUBE, FCST, HIND, catalog, climo, cube, hindcast, table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return keep


@query(f"""WITH {CUBE} SELECT model, CAST(lead_ix + CASE WHEN model LIKE 'A%' THEN 1.5 ELSE 0.5 END AS DOUBLE) AS lead_days, COUNT(*) AS n FROM cube
WHERE lead_ix + CASE WHEN model LIKE 'A%' THEN 1.5 ELSE 0.5 END <= 20 GROUP BY 1, 2""")
def labelled_leads(spark, sf_dir):
    """P7, P9."""
    c = cube(spark, sf_dir).withColumn("provider", F.when(F.col("model").startswith("A"), "GEFS").otherwise("X"))
    return no.cap_lead(no.label_leads(c), 20).groupBy("model", F.col("lead_days").cast("double").alias("lead_days")).agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority AS model, ROUND(CAST((o_custkey % 48) / 24.0 AS FLOAT), 4)::DOUBLE AS lead_days, COUNT(*) AS n FROM orders GROUP BY 1, 2".replace("ROUND(CAST((o_custkey % 48) / 24.0 AS FLOAT), 4)::DOUBLE", "ROUND((o_custkey % 48) / 24.0, 4)::DOUBLE"))
def leads_of_valid_times(spark, sf_dir):
    """P8."""
    start = F.col("o_orderdate").cast("timestamp_ntz")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("model"), start.alias("init_ts"), F.timestamp_add("HOUR", (F.col("o_custkey") % 48).cast("int"), start).alias("valid_ts"))
    return no.lead_from_valid(o).groupBy("model", F.round(F.col("lead_days").cast("double"), 4).alias("lead_days")).agg(F.count("*").alias("n"))


@query(f"WITH {CUBE} SELECT model, var, member, COUNT(*) AS n FROM cube WHERE (var = 'pr' AND member = 1) OR (var = 'tas' AND member = 2) GROUP BY 1, 2, 3")
def selected_level(spark, sf_dir):
    """P10: the member stands for the level."""
    c = cube(spark, sf_dir).withColumn("level", F.col("member") * 100)
    dims = c.select("model", "var").distinct().withColumn("level", F.when(F.col("var") == "pr", 100).otherwise(200))
    return no.select_level(c, dims).groupBy("model", "var", "member").agg(F.count("*").alias("n"))


@query(f"WITH {CUBE} SELECT model, var, COUNT(*) AS n FROM cube GROUP BY 1, 2")
def renamed_variables(spark, sf_dir):
    """P13, P5."""
    c = cube(spark, sf_dir).withColumn("var", F.when(F.col("var") == "pr", "PRECTOTCORR").when(F.col("member") == 1, "T2M").otherwise(F.col("var")))
    c = no.canonical_columns(c.withColumnsRenamed({"lat": "Latitude", "lon": "X", "member": "M"})).select("model", "var", "lat", "lon", "member")
    return no.rename_vars(c).groupBy("model", "var").agg(F.count("*").alias("n"))


@query(f"""WITH {CAT} SELECT DISTINCT model, var, CASE WHEN var = 'v1' THEN var ELSE var || '_200' END AS name, 'p95_below' AS tag, 'a_' || var || '_b' AS safe, substr(model, 3) AS legacy FROM files""")
def output_names(spark, sf_dir):
    """P14."""
    level = F.when(F.col("var") == "v1", F.lit(None).cast("int")).otherwise(200)
    return catalog(spark, sf_dir).select("model", "var", no.output_name(F.col("var"), level).alias("name"), no.product_tag(F.lit(95), F.lit("below")).alias("tag"), no.safe_tag(F.concat(F.lit("a ("), F.col("var"), F.lit(") b"))).alias("safe"), no.legacy_model(F.col("model")).alias("legacy")).distinct()


@query(f"""WITH {CUBE}, k AS (SELECT DISTINCT model, var, init_date, member, lead_ix, valid_date, lat, lon FROM cube WHERE member <= 2)
SELECT model, var, CAST(h AS INT) AS hour, COUNT(*) AS n, SUM(CASE WHEN h = (member - 1) * 12 THEN 1 ELSE 0 END)::BIGINT AS filled FROM k CROSS JOIN (VALUES (0), (6), (12), (18)) t(h) GROUP BY 1, 2, 3""")
def sub_daily_starts(spark, sf_dir):
    """The first two members start at 00 and 12."""
    c = cube(spark, sf_dir).where("member <= 2").withColumn("init_ts", F.timestamp_add("HOUR", (F.col("member") - 1) * 12, F.col("init_date").cast("timestamp_ntz")))
    return no.start_spine(c).groupBy("model", "var", F.hour("init_ts").alias("hour")).agg(F.count("*").alias("n"), F.count("value").alias("filled"))


@query(f"""WITH {CUBE}, m AS (SELECT model, var, lead_ix, CAST(lat AS INT) AS level, SUM(value) AS value FROM cube WHERE NOT (var = 'pr' AND lat = 10) AND lon = 0 GROUP BY 1, 2, 3, 4),
s AS (SELECT k.*, l.level FROM (SELECT DISTINCT model, var, lead_ix FROM m) k JOIN (SELECT DISTINCT model, level FROM m) l USING (model))
SELECT s.model, s.var, s.level, COUNT(*) AS n, COUNT(value) AS filled FROM s LEFT JOIN m USING (model, var, lead_ix, level) GROUP BY 1, 2, 3""")
def padded_levels(spark, sf_dir):
    """A level that one variable lacks."""
    c = cube(spark, sf_dir).where("NOT (var = 'pr' AND lat = 10) AND lon = 0").groupBy("model", "var", "lead_ix", F.col("lat").cast("int").alias("level")).agg(F.sum("value").alias("value"))
    return no.pad_union(c, "level", over=("model",)).groupBy("model", "var", "level").agg(F.count("*").alias("n"), F.count("value").alias("filled"))


@query(f"""WITH {CUBE} SELECT model, var, lead_ix, CAST(lead_ix + CASE WHEN var = 'tas' THEN 0.0 WHEN model LIKE 'R%' THEN 1.0 ELSE 0.5 END AS DOUBLE) AS lead_days, lead_ix + 0.5::DOUBLE AS reference FROM cube
WHERE lead_ix < 30 AND (var = 'tas' OR model LIKE 'R%') GROUP BY 1, 2, 3, 4, 5""")
def drifted_leads(spark, sf_dir):
    """P22."""
    c = _leads(spark, sf_dir)
    ref = c.where("model = 'A-F' AND var = 'pr' AND lead_ix < 30").select("lead_ix", F.col("lead_days").cast("double").alias("lead_days")).distinct()
    return no.lead_drift(c, ref).select("model", "var", "lead_ix", F.col("lead_days").cast("double").alias("lead_days"), "reference")


@query(f"WITH {CUBE} SELECT model, var, lead_ix, COUNT(*) AS n FROM cube WHERE lead_ix < 30 GROUP BY 1, 2, 3")
def aligned_leads(spark, sf_dir):
    """Every label is the reference's."""
    c = _leads(spark, sf_dir)
    ref = c.where("model = 'A-F' AND var = 'pr' AND lead_ix < 30").select("lead_ix", "lead_days").distinct()
    return no.align_leads(c, ref).where(F.col("lead_days") == F.col("lead_ix") + 0.5).groupBy("model", "var", "lead_ix").agg(F.count("*").alias("n"))


@query(f"""WITH {CUBE}, {CLIMO} SELECT model, var, member, COUNT(*) AS n, ROUND(SUM(value), 3) AS total FROM
(SELECT model, var, member, value FROM cube WHERE model = 'A-F' UNION ALL SELECT 'mean', var, -1, value FROM climo WHERE model = 'N-O') GROUP BY 1, 2, 3""")
def stacked_models(spark, sf_dir):
    """A source without members beside one with."""
    mean = climo(spark, sf_dir).where("model = 'N-O'").withColumn("model", F.lit("mean"))
    s = no.stack_models(cube(spark, sf_dir).where("model = 'A-F'"), mean)
    return s.groupBy("model", "var", F.coalesce("member", F.lit(-1)).alias("member")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query(f"WITH {CUBE}, {CLIMO} SELECT 'M' AS model, var, COUNT(*) AS n, ROUND(SUM(value), 3) AS total FROM climo WHERE model = 'A-O' GROUP BY 2")
def first_climatology(spark, sf_dir):
    """J6."""
    names = spark.sql("SELECT * FROM VALUES ('M', 'A-X', 0), ('M', 'A-O', 1), ('M', 'N-O', 2) AS t(model, name, cand_ix)")
    return an.first_available(climo(spark, sf_dir), names).groupBy("model", "var").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query(f"WITH {HIND} SELECT DISTINCT model, strftime(init_date, '%m%d') AS mmdd FROM hind WHERE NOT (model = 'A' OR extract(month FROM init_date) = 2)")
def threshold_split(spark, sf_dir):
    """Month-days that aren't stored yet."""
    keys = ["model", "mmdd"]
    t = hindcast(spark, sf_dir).select("model", F.date_format("init_date", "MMdd").alias("mmdd")).distinct()
    return th.split_thresholds(t, t.where("model = 'A' OR mmdd LIKE '02%'"), keys)


@query(f"""WITH {HIND}, m AS (SELECT model, var, AVG(value * 2) AS mean, COUNT(CASE WHEN lead_ix > 0 THEN value END) AS finite, COUNT(*) AS total, AVG(CASE WHEN lead_ix > 0 THEN value * 2 END) AS p FROM hind GROUP BY 1, 2)
SELECT model, var, CASE model WHEN 'A' THEN 'ok' WHEN 'N' THEN 'no_threshold_within_7_days' ELSE 'missing_threshold' END AS status, CASE WHEN model = 'A' THEN '0303' END AS mmdd, ROUND(p, 6) AS mean, finite, total FROM m""")
def exceedance_report(spark, sf_dir):
    """A12."""
    h = hindcast(spark, sf_dir)
    cat = spark.sql("SELECT * FROM VALUES ('A', 'pr', '0303'), ('A', 'pr', '0501'), ('N', 'pr', '0601') AS t(model, var, mmdd)")
    p = h.select("model", "var", F.when(F.col("lead_ix") > 0, F.col("value") * 2).alias("probability"))
    r = ex.exceedance_report(h.select("model", "var").distinct(), cat, p, "0305")
    return r.select("model", "var", "status", "mmdd", F.round("mean", 6).alias("mean"), "finite", "total")


@query(f"""WITH {CUBE} SELECT model, var, model NOT LIKE 'R%' AND var = 'pr' AS compatible FROM (SELECT DISTINCT model, var FROM cube)""")
def schema_parity(spark, sf_dir):
    """V3: sizes from the data; the shadow of R models has fewer cells, that of tas another name."""
    c = cube(spark, sf_dir)

    def side(df, name):
        d = df.groupBy("model", "var").agg(F.countDistinct("lead_ix").alias("t"), F.countDistinct("lat").alias("y"), F.countDistinct("lon").alias("x"))
        dims = F.create_map(F.lit("time"), "t", F.lit("lat"), "y", F.lit("lon"), "x")
        return d.select("model", "var", dims.alias("dims"), F.array(name).alias("names"))

    shadow = side(c.where("NOT (model LIKE 'R%' AND lon = 0)"), F.when(F.col("var") == "pr", "PR_sfc").otherwise("other"))
    return va.schema_parity(side(c, F.col("var")), shadow)


@query(f"SELECT CAST(range AS INT) AS week, DATE '{FCST}' + 2 + 7 * (CAST(range AS INT) - 1) AS week_start, DATE '{FCST}' + 8 + 7 * (CAST(range AS INT) - 1) AS week_end, (SELECT COUNT(*) FROM orders WHERE dayofyear(o_orderdate) BETWEEN dayofyear(DATE '{FCST}' + 2 + 7 * (CAST(range AS INT) - 1)) AND dayofyear(DATE '{FCST}' + 8 + 7 * (CAST(range AS INT) - 1))) AS n FROM range(1, 5)")
def forecast_weeks(spark, sf_dir):
    """Orders by the forecast week that their day of the year falls in."""
    weeks = ca.week_dim(spark, FCST)
    days = weeks.select("*", F.explode(F.sequence(F.dayofyear("week_start"), F.dayofyear("week_end"))).alias("doy"))
    o = table(spark, sf_dir, "orders").select(F.dayofyear("o_orderdate").alias("doy"))
    return o.join(F.broadcast(days), "doy").groupBy("week", "week_start", "week_end").agg(F.count("*").alias("n"))


@query("""SELECT CAST(o_orderdate AS DATE) + CAST(range AS INT) - 6 AS day, COUNT(*) AS n FROM orders CROSS JOIN range(0, 7) GROUP BY 1""")
def days_before_forecasts(spark, sf_dir):
    """D2."""
    day = F.explode(ca.forecast_week(F.col("o_orderdate").cast("date"))).alias("day")
    return table(spark, sf_dir, "orders").select(day).groupBy("day").agg(F.count("*").alias("n"))


@query("""SELECT CAST(o_custkey % 4 * 6 AS INT) AS hour, COUNT(*) AS n, MIN(CAST(o_orderdate AS DATE)) AS first FROM orders GROUP BY 1""")
def sub_daily_times(spark, sf_dir):
    """D8."""
    label = F.concat(F.lpad((F.col("o_custkey") % 4 * 6).cast("string"), 2, "0"), F.lit("z"))
    t = table(spark, sf_dir, "orders").select(ca.sub_daily_start(F.col("o_orderdate").cast("date"), label).alias("ts"))
    return t.groupBy(F.hour("ts").alias("hour")).agg(F.count("*").alias("n"), F.min(F.col("ts").cast("date")).alias("first"))


@query(f"WITH {CUBE} SELECT (SELECT string_agg(DISTINCT var, ',' ORDER BY var) FROM cube) AS mean_variables, (SELECT string_agg(DISTINCT var, ',' ORDER BY var) FROM cube WHERE var LIKE 't%') AS member_variables")
def product_attributes(spark, sf_dir):
    """S18."""
    c = cube(spark, sf_dir)
    a = sk.product_attributes(c, c.where("var LIKE 't%'"))
    return a.select(*[F.array_join(x, ",").alias(x) for x in a.columns])


@query(f"WITH {CUBE} SELECT model, var, COUNT(*) AS cells, true AS same FROM cube GROUP BY 1, 2")
def fingerprints_unmoved(spark, sf_dir):
    """Relabelling leads leaves the data as they were."""
    c = _leads(spark, sf_dir)
    a, b = ar.fingerprint(c), ar.fingerprint(ar.shift_leads(c)).withColumnsRenamed({"cells": "c2", "digest": "d2"})
    return a.join(b, ["model", "var"]).select("model", "var", "cells", ((F.col("cells") == F.col("c2")) & (F.col("digest") == F.col("d2"))).alias("same"))


@query(f"WITH {CUBE} SELECT model, 'pr' AS var, COUNT(*) AS odd FROM cube WHERE var = 'pr' AND model LIKE 'R%' GROUP BY 1")
def unexpected_leads(spark, sf_dir):
    """Labels that are neither whole numbers nor half days."""
    return ar.unexpected_leads(_leads(spark, sf_dir)).select("model", "var", "odd")


@query("""WITH f AS (SELECT DISTINCT CAST(o_orderdate AS DATE) + 1 AS fcst_date FROM orders), i AS (SELECT CAST(o_orderdate AS DATE) AS fcst_date, COUNT(*) AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
SELECT fcst_date, COALESCE(n, 0) AS inputs, n IS NULL AS smoke_mode FROM f LEFT JOIN i USING (fcst_date)""")
def smoke_run(spark, sf_dir):
    """V5: a run on the day after each order, with some of the orders as input; days without any run in smoke mode."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("fcst_date"), "o_orderkey")
    return va.smoke_runs(o.where("o_orderkey % 3 = 0"), o.select(F.date_add("fcst_date", 1).alias("fcst_date")), True)


@query(f"""WITH {CUBE}, s AS (SELECT model, var, lead_ix, CASE WHEN var = 'pr' THEN value / 1e5 ELSE value END AS value FROM cube)
SELECT model, var, ROUND(SUM(CASE WHEN var = 'pr' AND (SELECT MAX(value) FROM s WHERE var = 'pr') < 1 THEN value * 86400 ELSE value END), 4) AS total FROM s GROUP BY 1, 2""")
def reader_units(spark, sf_dir):
    """A variable that never reaches 1 is taken for a rate."""
    c = cube(spark, sf_dir).withColumn("value", F.when(F.col("var") == "pr", F.col("value") / 1e5).otherwise(F.col("value")))
    return no.convert_units(c, "reader").groupBy("model", "var").agg(F.round(F.sum("value"), 4).alias("total"))


@query(f"""WITH {CUBE} SELECT model, COUNT(*) AS n, COUNT(CASE WHEN lead_ix % 5 <> 0 THEN value END) AS filled FROM cube GROUP BY 1""")
def missing_values(spark, sf_dir):
    """NaN becomes null at the boundary."""
    c = cube(spark, sf_dir).withColumn("value", F.when(F.col("lead_ix") % 5 == 0, float("nan")).otherwise(F.col("value")))
    return cu.missing_to_null(c).groupBy("model").agg(F.count("*").alias("n"), F.count("value").alias("filled"))
