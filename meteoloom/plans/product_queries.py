"""Queries of the weekly products, exceedance, hindcast statistics, grids and terciles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import week_dim
from ..operators import anomaly as an
from ..operators import climatology as cl
from ..operators import exceedance as ex
from ..operators import normalise as no
from ..operators import quality as qu
from ..operators import regions as rg
from ..operators import regrid as gr
from ..operators import tercile as te
from ..operators import thresholds as th
from ..operators import weekly as wk
from .fixtures import CLIMO, CUBE, FCST, HIND, climo, cube, hindcast, table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return keep


def _r(col: str, digits: int = 4):
    return F.round(col, digits).alias(col)


ANOM = """anom AS (SELECT e.model, e.var, init_date, e.lead_ix, valid_date, e.lat, e.lon, e.value - c.value AS value FROM
  (SELECT model, var, init_date, lead_ix, valid_date, lat, lon, AVG(value) AS value FROM cube GROUP BY ALL) e
  JOIN climo c ON e.model = c.model AND e.var = c.var AND e.lead_ix = c.lead_ix AND e.lat = c.lat AND e.lon = c.lon)"""
WEEK = f"""CAST(floor((date_diff('day', DATE '{FCST}', valid_date) - 2) / 7.0) + 1 AS INT)"""
WEEKLY = f"""wk AS (SELECT k.model, k.var, k.lat, k.lon, w.week, CASE WHEN k.var = 'pr' THEN COALESCE(SUM(a.value * 86400), 0) ELSE AVG(a.value) END AS value
  FROM (SELECT DISTINCT model, var, lat, lon FROM anom) k CROSS JOIN (SELECT CAST(range AS INT) AS week FROM range(1, 5)) w
  LEFT JOIN anom a ON a.model = k.model AND a.var = k.var AND a.lat = k.lat AND a.lon = k.lon AND {WEEK.replace('valid_date', 'a.valid_date')} = w.week
  GROUP BY 1, 2, 3, 4, 5)"""


def _weekly(spark, sf_dir):
    a = an.anomaly(cube(spark, sf_dir), climo(spark, sf_dir)).drop("init_date")
    return wk.weekly_reduce(a, FCST)


@query(f"""WITH {CUBE}, {CLIMO}, {ANOM}, {WEEKLY}
SELECT model, var, lat, lon, week, ROUND(value, 4) AS value FROM wk
UNION ALL SELECT 'SUBC-MME', var, lat, lon, week, ROUND(AVG(value), 4) FROM wk GROUP BY 2, 3, 4, 5""")
def weekly_multi_model_mean(spark, sf_dir):
    """The flagship."""
    return wk.multi_model_mean(_weekly(spark, sf_dir)).select("model", "var", "lat", "lon", "week", _r("value"))


@query(f"""WITH {CUBE}, {CLIMO}, {ANOM}, {WEEKLY}
SELECT model, var, lat, lon, ROUND(CASE WHEN var = 'pr' THEN SUM(value) ELSE AVG(value) END, 4) AS value FROM wk WHERE week IN (3, 4) GROUP BY 1, 2, 3, 4""")
def weeks_3_4(spark, sf_dir):
    """A6."""
    return wk.weeks34(_weekly(spark, sf_dir)).select("model", "var", "lat", "lon", _r("value"))


@query(f"""WITH {CUBE}, {CLIMO}, {ANOM}, {WEEKLY},
box AS (SELECT * FROM (VALUES ('a', 0.0, 90.0, 0.0, 10.0), ('b', 80.0, 200.0, -5.0, 5.0)) t(region, west, east, south, north)),
allw AS (SELECT model, var, lat, lon, week, value FROM wk UNION ALL
  SELECT model, var, lat, lon, 34, CASE WHEN var = 'pr' THEN SUM(value) ELSE AVG(value) END FROM wk WHERE week IN (3, 4) GROUP BY 1, 2, 3, 4)
SELECT region, model, var, lat, lon, week, ROUND(value, 4) AS value FROM allw JOIN box ON lon BETWEEN west AND east AND lat BETWEEN south AND north""")
def region_weekly(spark, sf_dir):
    """F4, S19."""
    boxes = spark.sql("SELECT * FROM VALUES ('a', 0D, 90D, 0D, 10D), ('b', 80D, 200D, -5D, 5D) AS t(region, west, east, south, north)")
    return rg.region_weekly(_weekly(spark, sf_dir), boxes).select("region", "model", "var", "lat", "lon", "week", _r("value"))


@query(f"""WITH {CUBE} SELECT lat, lon, model, var, member, lead_ix, value, 'w' AS region FROM cube WHERE (lon >= 260 OR lon <= 90) AND lat BETWEEN 5 AND 15""")
def region_across_dateline(spark, sf_dir):
    """F5."""
    box = spark.sql("SELECT 'w' AS region, 260D AS west, 90D AS east, 5D AS south, 15D AS north")
    return rg.clip_region(cube(spark, sf_dir), box, wrap=True).select("lat", "lon", "model", "var", "member", "lead_ix", "value", "region")


@query(f"""WITH {CUBE}, d AS (SELECT *, CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS x FROM cube)
SELECT x AS lon, lat, var, COUNT(*) AS n, SUM(value) AS total FROM d WHERE x BETWEEN -90 AND 100 AND lat BETWEEN 0 AND 5 GROUP BY 1, 2, 3""")
def domain_view(spark, sf_dir):
    """P3, P4."""
    d = rg.domain_view(no.ensure_lon(no.ensure_lon(cube(spark, sf_dir), "negpos"), "0_360"), (100, -90), (0, 5))
    return d.groupBy("lon", "lat", "var").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query(f"""WITH {CUBE}, {CLIMO} SELECT c.model, c.var, member, c.lead_ix, c.lat, c.lon, ROUND(c.value - k.value, 4) AS value FROM cube c JOIN climo k
ON c.model = k.model AND c.var = k.var AND c.lead_ix = k.lead_ix AND c.lat = k.lat AND c.lon = k.lon""")
def member_anomaly(spark, sf_dir):
    """J2."""
    return an.anomaly(cube(spark, sf_dir), climo(spark, sf_dir), per_member=True).select("model", "var", "member", "lead_ix", "lat", "lon", _r("value"))


@query(f"""WITH {CUBE}, {CLIMO}, e AS (SELECT model, var, valid_date, lat, lon, AVG(value) AS value FROM cube GROUP BY 1, 2, 3, 4, 5),
f AS (SELECT model, MIN(valid_date) AS first_valid FROM cube GROUP BY 1)
SELECT e.model, e.var, e.valid_date, e.lat, e.lon, ROUND(e.value - c.value, 4) AS value FROM e JOIN f USING (model)
JOIN climo c ON c.model = e.model AND c.var = e.var AND c.lat = e.lat AND c.lon = e.lon AND f.first_valid + c.lead_ix - 1 = e.valid_date""")
def anomaly_by_valid_date(spark, sf_dir):
    """J3."""
    c = cube(spark, sf_dir)
    first = c.groupBy("model").agg(F.min("valid_date").alias("first_valid"))
    shifted = an.climo_valid_dates(climo(spark, sf_dir), first)
    return an.anomaly(c.drop("init_date", "lead_ix"), shifted, align="date").select("model", "var", "valid_date", "lat", "lon", _r("value"))


@query(f"""WITH {CUBE}, n AS (SELECT model, MAX(n) AS nens FROM (SELECT model, var, COUNT(DISTINCT member) AS n FROM cube GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT model, MAX(init_date) AS init_date FROM cube GROUP BY 1)
SELECT model, init_date, CAST(nens AS BIGINT) AS nens FROM n JOIN r USING (model) UNION ALL SELECT 'SUBC-MME', DATE '{FCST}', CAST(SUM(nens) AS BIGINT) FROM n""")
def ensemble_sizes(spark, sf_dir):
    """A10, J13."""
    c = cube(spark, sf_dir)
    runs = an.ensemble_size(c).join(c.groupBy("model").agg(F.max("init_date").alias("init_date")), "model")
    names = runs.select("model").unionByName(spark.range(1).select(F.lit("SUBC-MME").alias("model")))
    return an.enrich_runs(names, runs, FCST).select("model", "init_date", "nens")


@query(f"""WITH {CUBE}, w AS (SELECT model, var, member, lat, lon, {WEEK} AS week, CASE WHEN var = 'pr' THEN SUM(value * 86400) ELSE AVG(value) END AS value
  FROM cube WHERE {WEEK} BETWEEN 1 AND 4 GROUP BY 1, 2, 3, 4, 5, 6),
s AS (SELECT k.*, week, CASE WHEN k.var = 'pr' THEN COALESCE(value, 0) ELSE value END AS value FROM (SELECT DISTINCT model, var, member, lat, lon FROM cube) k
  CROSS JOIN (SELECT CAST(range AS INT) AS week FROM range(1, 5)) LEFT JOIN w USING (model, var, member, lat, lon, week))
SELECT model, var, lat, lon, week, ROUND(MIN(value), 4) AS min, ROUND(AVG(value), 4) AS mean, ROUND(MAX(value), 4) AS max FROM s GROUP BY 1, 2, 3, 4, 5""")
def member_stats(spark, sf_dir):
    """A4 for members (Q1), A7."""
    weekly = wk.weekly_reduce(cube(spark, sf_dir).drop("init_date"), FCST)
    return wk.member_stats(weekly).select("model", "var", "lat", "lon", "week", _r("min"), _r("mean"), _r("max"))


@query(f"""WITH {CUBE}, p AS (SELECT model, lat, lon, {WEEK} AS week, member, SUM(value * 86400) AS value FROM cube WHERE var = 'pr' AND {WEEK} BETWEEN 1 AND 4 GROUP BY 1, 2, 3, 4, 5),
s AS (SELECT k.*, week, COALESCE(value, 0) AS value FROM (SELECT DISTINCT model, member, lat, lon FROM cube) k CROSS JOIN (SELECT CAST(range AS INT) AS week FROM range(1, 5))
  LEFT JOIN p USING (model, member, lat, lon, week)),
t AS (SELECT DATE '{FCST}' + 1 + 7 * week AS "time", lat, lon, split_part(model, '-', 2) AS m, MIN(value) AS a, AVG(value) AS b, MAX(value) AS c FROM s WHERE model LIKE 'N-%' OR model LIKE 'A-%' GROUP BY 1, 2, 3, model)
SELECT "time", lat, lon, ROUND(MAX(a) FILTER (m = 'F'), 2) AS f_min, ROUND(MAX(c) FILTER (m = 'F'), 2) AS f_max, ROUND(MAX(b) FILTER (m = 'O'), 2) AS o_mean
FROM (SELECT * FROM t WHERE (m = 'F') OR (m = 'O')) GROUP BY 1, 2, 3""".replace("model LIKE 'N-%' OR model LIKE 'A-%'", "model IN ('A-F', 'N-O')"))
def legacy_member_table(spark, sf_dir):
    """S20, P14."""
    c = cube(spark, sf_dir).where((F.col("var") == "pr") & F.col("model").isin("A-F", "N-O"))
    wide = wk.legacy_member_stats(wk.weekly_reduce(c.drop("init_date"), FCST), FCST, ["F", "O"])
    return wide.select("time", "lat", "lon", F.round("F_min", 2).alias("f_min"), F.round("F_max", 2).alias("f_max"), F.round("O_mean", 2).alias("o_mean"))


@query(f"""WITH {CUBE}, o AS (SELECT model, var, member, lat, lon, CAST(lead_ix // 7 + 1 AS INT) AS week, AVG(value) AS value FROM cube WHERE lead_ix < 28 GROUP BY ALL)
SELECT model, var, member, lat, lon, week, ROUND(value, 4) AS value FROM o UNION ALL SELECT 'SUBC-MME', var, member, lat, lon, week, ROUND(AVG(value), 4) FROM o GROUP BY 2, 3, 4, 5, 6""")
def weekly_by_position(spark, sf_dir):
    """A13."""
    w = wk.weekly_by_position(cube(spark, sf_dir).drop("init_date"))
    return w.select("model", "var", "member", "lat", "lon", "week", _r("value"))


@query(f"""WITH {CUBE}, n AS (SELECT MIN(m) AS m FROM (SELECT model, MAX(lead_ix) AS m FROM cube GROUP BY 1))
SELECT var, member, lead_ix, lat, lon, ROUND(AVG(value), 4) AS value FROM cube, n WHERE lead_ix <= m GROUP BY 1, 2, 3, 4, 5""")
def shortest_mme(spark, sf_dir):
    """A13, full leads."""
    return wk.shortest_mme(cube(spark, sf_dir)).select("var", "member", "lead_ix", "lat", "lon", _r("value"))


@query(f"""WITH {CUBE}, k AS (SELECT model, var, init_date, lead_ix, ROW_NUMBER() OVER (PARTITION BY model, var ORDER BY lead_ix) - 1 AS ix FROM
  (SELECT DISTINCT model, var, init_date, lead_ix FROM cube WHERE lead_ix % 3 <> 1))
SELECT model, var, CAST(ix AS INT) AS lead_ix, CAST(lead_ix + 0.5 AS DOUBLE) AS lead_days, COUNT(*) AS n FROM cube JOIN k USING (model, var, init_date, lead_ix) GROUP BY 1, 2, 3, 4""")
def lead_positions(spark, sf_dir):
    """W3."""
    c = cube(spark, sf_dir).where("lead_ix % 3 <> 1").withColumn("lead_days", F.col("lead_ix") + 0.5)
    return no.lead_position(c).groupBy("model", "var", "lead_ix", F.col("lead_days").cast("double").alias("lead_days")).agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ exceedance

_FILL = """b AS (SELECT model, var, MIN(lead_ix) AS lo, MAX(lead_ix) AS hi FROM cube GROUP BY 1, 2),
leads AS (SELECT DISTINCT model, var, lead_ix, valid_date FROM cube),
full_ AS (SELECT k.model, k.var, k.lat, k.lon, k.member, l.lead_ix, l.valid_date, c.value FROM (SELECT DISTINCT model, var, lat, lon, member FROM cube) k
  JOIN leads l USING (model, var) LEFT JOIN cube c USING (model, var, lat, lon, member, lead_ix)),
thr AS (SELECT model, var, lead_ix, lat, lon, value {op} AS threshold FROM climo),
crs AS (SELECT f.*, CASE WHEN f.value {cmp} t.threshold THEN 1 ELSE 0 END AS x FROM full_ f JOIN thr t USING (model, var, lead_ix, lat, lon)),
flg AS (SELECT crs.*, SUM(x) OVER (PARTITION BY model, var, lat, lon, member ORDER BY lead_ix RANGE BETWEEN {back} PRECEDING AND CURRENT ROW) AS d FROM crs),
out_ AS (SELECT model, var, lat, lon, lead_ix, valid_date, CAST(SUM(CASE WHEN d >= {need} THEN 1 ELSE 0 END) AS BIGINT) AS "count", COUNT(*) AS members FROM flg
  JOIN (SELECT model AS m, var AS v, MIN(lead_ix) AS first_ FROM crs GROUP BY 1, 2) ON m = model AND v = var WHERE lead_ix >= first_ + {back} GROUP BY 1, 2, 3, 4, 5, 6)"""


def _ex_sql(op: str, cmp: str, window: int, need: int) -> str:
    return f"WITH {CUBE}, {CLIMO}, " + _FILL.format(op=op, cmp=cmp, back=window - 1, need=need)


def _exceed(spark, sf_dir, shift: float, **options):
    t = climo(spark, sf_dir).select("model", "var", "lead_ix", "lat", "lon", (F.col("value") + shift).alias("threshold"))
    return ex.exceedance(cube(spark, sf_dir), t, **options)


_EX_OUT = ' SELECT model, var, lat, lon, lead_ix, "count", members, ROUND(100.0 * "count" / members, 4) AS probability FROM out_'


def _ex_cols(df):
    return df.select("model", "var", "lat", "lon", "lead_ix", "count", "members", _r("probability"))


@query(_ex_sql("+ 10.25", ">", 7, 1) + _EX_OUT)
def exceedance_any(spark, sf_dir):
    """Any day of seven above."""
    return _ex_cols(_exceed(spark, sf_dir, 10.25))


@query(_ex_sql("+ 60.25", "<", 3, 3) + _EX_OUT)
def exceedance_all_below(spark, sf_dir):
    """All of three days below."""
    return _ex_cols(_exceed(spark, sf_dir, 60.25, window=3, direction="below", aggregate="all"))


@query(_ex_sql("+ 5.25", ">", 10, 3) + _EX_OUT)
def exceedance_min_days(spark, sf_dir):
    """At least three of ten days above."""
    return _ex_cols(_exceed(spark, sf_dir, 5.25, window=10, min_days=3))


@query(f"""WITH {CUBE}, {CLIMO}, late AS (SELECT *, CASE WHEN model LIKE 'R%' AND lead_ix < 3 THEN NULL WHEN model LIKE 'N%' AND lead_ix > 40 THEN NULL ELSE value END AS v FROM cube),
pos AS (SELECT model, var, lead_ix, valid_date, ROW_NUMBER() OVER (PARTITION BY model, var ORDER BY lead_ix) - 1 AS p FROM
  (SELECT DISTINCT l.model, l.var, l.lead_ix, l.valid_date FROM late l JOIN (SELECT model, var, MIN(lead_ix) AS a, MAX(lead_ix) AS b FROM late WHERE v IS NOT NULL GROUP BY 1, 2) x
   ON l.model = x.model AND l.var = x.var AND l.lead_ix BETWEEN a AND b)),
day AS (SELECT k.model, k.var, k.lat, k.lon, k.member, pos.p, pos.valid_date, CASE WHEN l.v > c.value + 10.25 THEN 1 ELSE 0 END AS x FROM (SELECT DISTINCT model, var, lat, lon, member FROM late) k
  JOIN pos ON pos.model = k.model AND pos.var = k.var JOIN climo c ON c.model = k.model AND c.var = k.var AND c.lat = k.lat AND c.lon = k.lon AND c.lead_ix = pos.p
  LEFT JOIN late l ON l.model = k.model AND l.var = k.var AND l.lat = k.lat AND l.lon = k.lon AND l.member = k.member AND l.valid_date = pos.valid_date),
win AS (SELECT a.model, a.var, a.lat, a.lon, a.member, a.p, a.valid_date, MAX(b.x) AS hit FROM day a JOIN day b ON a.model = b.model AND a.var = b.var AND a.lat = b.lat AND a.lon = b.lon AND a.member = b.member AND b.p BETWEEN a.p - 6 AND a.p
  WHERE a.p >= 6 GROUP BY 1, 2, 3, 4, 5, 6, 7)
SELECT model, var, lat, lon, CAST(p AS INT) AS lead_ix, valid_date, CAST(SUM(hit) AS BIGINT) AS "count", COUNT(*) AS members FROM win GROUP BY 1, 2, 3, 4, 5, 6""")
def exceedance_of_padded_models(spark, sf_dir):
    """Models whose first or last leads are empty meet their thresholds from position 0 on."""
    empty = (F.col("model").startswith("R") & (F.col("lead_ix") < 3)) | (F.col("model").startswith("N") & (F.col("lead_ix") > 40))
    c = cube(spark, sf_dir).withColumn("value", F.when(~empty, F.col("value")))
    t = climo(spark, sf_dir).select("model", "var", "lead_ix", "lat", "lon", (F.col("value") + 10.25).alias("threshold"))
    return ex.exceedance(c, t).select("model", "var", "lat", "lon", "lead_ix", "valid_date", "count", "members")


_POOL = _ex_sql("+ 10.25", ">", 7, 1) + """, nens AS (SELECT model, MAX(n) AS nens FROM (SELECT model, var, COUNT(DISTINCT member) AS n FROM cube GROUP BY 1, 2) GROUP BY 1),
pool AS (SELECT var, valid_date, lat, lon, CAST(SUM("count") AS BIGINT) AS "count", CAST(SUM(nens) AS BIGINT) AS nens FROM out_ JOIN nens USING (model) GROUP BY 1, 2, 3, 4
  HAVING COUNT(DISTINCT model) = (SELECT COUNT(DISTINCT model) FROM out_))"""


def _pooled(spark, sf_dir):
    counts = _exceed(spark, sf_dir, 10.25).select("var", "model", "valid_date", "lat", "lon", "count")
    return ex.pool_models(counts, an.ensemble_size(cube(spark, sf_dir)))


@query(_POOL + ' SELECT var, valid_date, lat, lon, "count", nens, ROUND(100.0 * "count" / nens, 4) AS probability FROM pool')
def pooled_probability(spark, sf_dir):
    """J10, A9."""
    return _pooled(spark, sf_dir).select("var", "valid_date", "lat", "lon", "count", "nens", _r("probability"))


@query(_POOL + f""", wks AS (SELECT CAST(range AS INT) AS week, DATE '{FCST}' + 8 + 7 * (CAST(range AS INT) - 1) AS week_end FROM range(1, 8)),
pick AS (SELECT week, valid_date FROM (SELECT week, valid_date, ROW_NUMBER() OVER (PARTITION BY week ORDER BY abs(date_diff('day', week_end, valid_date)), valid_date) AS n
  FROM (SELECT DISTINCT valid_date FROM pool) CROSS JOIN wks WHERE abs(date_diff('day', week_end, valid_date)) <= 3) WHERE n = 1)
SELECT week, week_end, pick.valid_date AS picked_date, var, lat, lon, ROUND(100.0 * "count" / nens, 4) AS probability FROM wks LEFT JOIN pick USING (week) LEFT JOIN pool ON pool.valid_date = pick.valid_date""")
def week_window_pick(spark, sf_dir):
    """W4."""
    weeks = week_dim(spark, FCST, 7).select("week", "week_end")
    return ex.pick_week_window(_pooled(spark, sf_dir), weeks).select("week", "week_end", "picked_date", "var", "lat", "lon", _r("probability"))


# ------------------------------------------------------------------ hindcast statistics

_DOY = f"""WITH {HIND}, m AS (SELECT model, var, lead_ix, lat, lon, init_date, AVG(value) AS value FROM
  (SELECT model, var, lead_ix, lat, lon, init_date, member, AVG(value) AS value FROM hind GROUP BY ALL) GROUP BY 1, 2, 3, 4, 5, 6),
doy AS (SELECT model, var, lead_ix, lat, lon, CAST(dayofyear(init_date) AS INT) AS doy, AVG(value) AS value FROM m GROUP BY 1, 2, 3, 4, 5, 6)"""
_SMOOTH = """fy AS (SELECT k.*, d.doy, doy.value FROM (SELECT DISTINCT model, var, lead_ix, lat, lon FROM doy) k CROSS JOIN (SELECT CAST(range AS INT) AS doy FROM range(1, 367)) d
  LEFT JOIN doy USING (model, var, lead_ix, lat, lon, doy)),
p1 AS (SELECT *, doy + s AS pos FROM fy CROSS JOIN (VALUES (0), (-366), (366)) t(s) WHERE doy + s BETWEEN -14 AND 381),
s1 AS (SELECT model, var, lead_ix, lat, lon, doy, s, AVG(value) OVER (PARTITION BY model, var, lead_ix, lat, lon ORDER BY pos RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS value FROM p1),
p2 AS (SELECT a.model, a.var, a.lead_ix, a.lat, a.lon, a.doy, a.value, t.s, a.doy + t.s AS pos FROM s1 a CROSS JOIN (VALUES (0), (-366), (366)) t(s) WHERE a.s = 0 AND a.doy + t.s BETWEEN -14 AND 381),
s2 AS (SELECT model, var, lead_ix, lat, lon, doy, s, AVG(value) OVER (PARTITION BY model, var, lead_ix, lat, lon ORDER BY pos RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS value FROM p2)"""


@query(_DOY + " SELECT model, var, lead_ix, lat, lon, doy, ROUND(value, 4) AS value FROM doy")
def climatology_by_day(spark, sf_dir):
    """A2."""
    return cl.doy_means(hindcast(spark, sf_dir)).select("model", "var", "lead_ix", "lat", "lon", "doy", _r("value"))


@query(_DOY + ", " + _SMOOTH + " SELECT model, var, lead_ix, lat, lon, doy, strftime(DATE '1959-12-31' + doy, '%m%d') AS mmdd, ROUND(value, 4) AS value FROM s2 WHERE s = 0")
def climatology_smoothed(spark, sf_dir):
    """A2, W1, D5."""
    return cl.climatology(hindcast(spark, sf_dir)).select("model", "var", "lead_ix", "lat", "lon", "doy", "mmdd", _r("value"))


@query(f"""WITH {HIND}, d AS (SELECT model, lead_ix, lon, value, CAST(dayofyear(('2000' || strftime(init_date, '-%m-%d'))::DATE) AS INT) AS sd FROM hind),
pool AS (SELECT model, lead_ix, lon, ((sd - 1 + o + 366) % 366) + 1 AS doy, value FROM d CROSS JOIN (SELECT CAST(range AS INT) AS o FROM range(-15, 16))),
own AS (SELECT model, sd, MIN(m) AS m FROM (SELECT model, init_date, CAST(dayofyear(('2000' || strftime(init_date, '-%m-%d'))::DATE) AS INT) AS sd, MAX(lead_ix) + 1 AS m FROM hind GROUP BY 1, 2, 3) GROUP BY 1, 2),
short AS (SELECT model, ((sd - 1 + o + 366) % 366) + 1 AS doy, MIN(m) AS least_ FROM own CROSS JOIN (SELECT CAST(range AS INT) AS o FROM range(-15, 16)) GROUP BY 1, 2),
r AS (SELECT pool.*, ROW_NUMBER() OVER (PARTITION BY model, lead_ix, lon, doy ORDER BY value NULLS LAST) AS n, COUNT(*) OVER (PARTITION BY model, lead_ix, lon, doy) AS c
  FROM pool JOIN short USING (model, doy) WHERE lead_ix < least_)
SELECT model, lead_ix, lon, CAST(doy AS INT) AS doy, strftime(DATE '1999-12-31' + CAST(doy AS INT), '%m%d') AS mmdd, value AS threshold FROM r WHERE n = CAST(round_even(0.95 * (c - 1), 0) AS BIGINT) + 1""")
def thresholds_p95(spark, sf_dir):
    """J15, A3, D5, D6."""
    return th.thresholds(hindcast(spark, sf_dir), 95).select("model", "lead_ix", "lon", "doy", "mmdd", "threshold")


_MMDD = f"""WITH {HIND}, c AS (SELECT DISTINCT model, strftime(init_date, '%m%d') AS mmdd FROM hind WHERE extract(day FROM init_date) % 11 = 3),
d AS (SELECT model, mmdd, CASE WHEN mmdd = '{{w}}' THEN 0 ELSE LEAST(abs(a - b), 366 - abs(a - b)) END AS distance FROM
  (SELECT *, CAST(dayofyear(('2000-' || mmdd[1:2] || '-' || mmdd[3:4])::DATE) AS INT) AS a, CAST(dayofyear(DATE '2000-{{m}}') AS INT) AS b FROM c))
SELECT model, '{{w}}' AS wanted, mmdd, CAST(distance AS INT) AS distance FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY distance, mmdd) AS n FROM d WHERE distance <= {{most}}) WHERE n = 1"""


def _labels(spark, sf_dir):
    h = hindcast(spark, sf_dir)
    return h.where(F.pmod(F.dayofmonth("init_date"), F.lit(11)) == 3).select("model", F.date_format("init_date", "MMdd").alias("mmdd")).distinct()


@query(_MMDD.format(w="0101", m="01-01", most=7))
def nearest_threshold(spark, sf_dir):
    """Around the year's end, within seven days."""
    return th.nearest_mmdd(_labels(spark, sf_dir), "0101", 7, ["model"])


@query(_MMDD.format(w="0709", m="07-09", most=400))
def nearest_label(spark, sf_dir):
    """Without a bound."""
    return th.nearest_mmdd(_labels(spark, sf_dir), "0709", None, ["model"])


# ------------------------------------------------------------------ grids and terciles


@query(f"""WITH {CUBE}, m AS (SELECT model, lat, lon, AVG(value) AS value FROM cube WHERE var = 'pr' GROUP BY 1, 2, 3),
g AS (SELECT * FROM (VALUES (5.0, 45.0), (2.5, 90.0), (10.0, 270.0), (5.0, 280.0)) t(lat, lon)),
c AS (SELECT g.lat, g.lon, m.model, m.value, (1 - abs(m.lat - g.lat) / 10) * (1 - abs(m.lon - g.lon) / 90) AS w FROM g JOIN m ON abs(m.lat - g.lat) < 10 AND abs(m.lon - g.lon) < 90)
SELECT k.model, g.lat::DOUBLE AS lat, g.lon::DOUBLE AS lon, ROUND(CASE WHEN SUM(w) > 0.999999 THEN SUM(w * value) END, 4) AS value FROM (SELECT DISTINCT model FROM m) k CROSS JOIN g LEFT JOIN c ON c.model = k.model AND c.lat = g.lat AND c.lon = g.lon GROUP BY 1, 2, 3""")
def bilinear(spark, sf_dir):
    """Outside the hull is missing."""
    mean = cube(spark, sf_dir).where("var = 'pr'").groupBy("model", "lat", "lon").agg(F.avg("value").alias("value"))
    grid = spark.sql("SELECT * FROM VALUES (5D, 45D), (2.5D, 90D), (10D, 270D), (5D, 280D) AS t(lat, lon)")
    return gr.bilinear(mean, grid, 10, 90).select("model", "lat", "lon", _r("value"))


@query(f"""WITH {CUBE}, m AS (SELECT model, lat, lon, AVG(value) AS value FROM cube WHERE var = 'pr' GROUP BY 1, 2, 3),
g AS (SELECT * FROM (VALUES (1.0, 5.0), (9.0, 95.0), (5.0, 185.0), (-80.0, 45.0), (75.0, 359.0)) t(lat, lon)),
r AS (SELECT model, g.lat, g.lon, m.value, ROW_NUMBER() OVER (PARTITION BY model, g.lat, g.lon ORDER BY abs(m.lat - g.lat), m.lat DESC, abs(m.lon - g.lon), m.lon DESC) AS n FROM m CROSS JOIN g)
SELECT model, lat::DOUBLE AS lat, lon::DOUBLE AS lon, ROUND(value, 4) AS value FROM r WHERE n = 1""")
def nearest_cell(spark, sf_dir):
    """Ties go to the greater label, far targets to the border."""
    mean = cube(spark, sf_dir).where("var = 'pr'").groupBy("model", "lat", "lon").agg(F.avg("value").alias("value"))
    grid = spark.sql("SELECT * FROM VALUES (1D, 5D), (9D, 95D), (5D, 185D), (-80D, 45D), (75D, 359D) AS t(lat, lon)")
    return gr.nearest_cell(mean, grid).select("model", "lat", "lon", _r("value"))


@query(f"""WITH {CUBE}, m AS (SELECT model, 0.5 - lat AS lat, lon / 90 + 0.25 AS lon, AVG(value) AS value FROM cube WHERE var = 'tas' GROUP BY 1, 2, 3),
g AS (SELECT * FROM (VALUES (0.5, 0.25), (-4.5, 1.0), (-2.0, 2.25), (-9.5, 3.0), (-9.5, 3.3), (0.6, 1.0)) t(lat, lon)),
c AS (SELECT g.lat, g.lon, m.model, m.value, (1 - abs(m.lat - g.lat) / 10) * (1 - abs(m.lon - g.lon)) AS w FROM g JOIN m ON abs(m.lat - g.lat) < 10 AND abs(m.lon - g.lon) < 1)
SELECT k.model, g.lat::DOUBLE AS lat, g.lon::DOUBLE AS lon, ROUND(CASE WHEN SUM(w) BETWEEN 0.999999 AND 1.000001 THEN SUM(w * value) END, 4) AS value
FROM (SELECT DISTINCT model FROM m) k CROSS JOIN g LEFT JOIN c ON c.model = k.model AND c.lat = g.lat AND c.lon = g.lon GROUP BY 1, 2, 3""")
def bilinear_between_steps(spark, sf_dir):
    """Cell centres that are no multiples of the step, latitudes from north to south."""
    place = {"lat": F.lit(0.5) - F.col("lat"), "lon": F.col("lon") / 90 + 0.25}
    mean = cube(spark, sf_dir).where("var = 'tas'").withColumns(place).groupBy("model", "lat", "lon").agg(F.avg("value").alias("value"))
    grid = spark.sql("SELECT * FROM VALUES (0.5D, 0.25D), (-4.5D, 1D), (-2D, 2.25D), (-9.5D, 3D), (-9.5D, 3.3D), (0.6D, 1D) AS t(lat, lon)")
    return gr.bilinear(mean, grid).select("model", "lat", "lon", _r("value"))


@query(f"""WITH {CUBE}, m AS (SELECT model, lat * lat / 10 AS lat, (lon / 90) * (lon / 90) AS lon, AVG(value) AS value FROM cube WHERE var = 'pr' GROUP BY 1, 2, 3),
g AS (SELECT * FROM (VALUES (5.0, 2.5), (10.0, 4.0), (0.5, 0.25), (9.0, 8.5), (9.0, 9.5)) t(lat, lon)),
c AS (SELECT g.lat, g.lon, m.model, m.value, (1 - abs(m.lat - g.lat) / 10) * CASE WHEN m.lon = g.lon THEN 1 WHEN m.lon < g.lon THEN 1 - (g.lon - m.lon) / (2 * sqrt(m.lon) + 1) ELSE 1 - (m.lon - g.lon) / (2 * sqrt(m.lon) - 1) END AS w
  FROM g JOIN m ON abs(m.lat - g.lat) < 10 AND m.lon > (CASE WHEN g.lon < 0 THEN 0 ELSE pow(floor(sqrt(g.lon)), 2) END) - 0.001 AND m.lon < pow(floor(sqrt(g.lon)) + 1, 2) + CASE WHEN g.lon = pow(floor(sqrt(g.lon)), 2) THEN -0.001 ELSE 0.001 END)
SELECT k.model, g.lat::DOUBLE AS lat, g.lon::DOUBLE AS lon, ROUND(CASE WHEN SUM(w) BETWEEN 0.999999 AND 1.000001 THEN SUM(w * value) END, 4) AS value
FROM (SELECT DISTINCT model FROM m) k CROSS JOIN g LEFT JOIN c ON c.model = k.model AND c.lat = g.lat AND c.lon = g.lon GROUP BY 1, 2, 3""")
def bilinear_on_uneven_axes(spark, sf_dir):
    """Longitudes 0, 1, 4 and 9."""
    place = {"lat": F.col("lat") * F.col("lat") / 10, "lon": (F.col("lon") / 90) * (F.col("lon") / 90)}
    mean = cube(spark, sf_dir).where("var = 'pr'").withColumns(place).groupBy("model", "lat", "lon").agg(F.avg("value").alias("value"))
    grid = spark.sql("SELECT * FROM VALUES (5D, 2.5D), (10D, 4D), (0.5D, 0.25D), (9D, 8.5D), (9D, 9.5D) AS t(lat, lon)")
    return gr.bilinear(mean, grid).select("model", "lat", "lon", _r("value"))


@query(f"""WITH {CUBE} SELECT lat, CAST(CAST(lon + 360 AS INT) % 360 AS DOUBLE) AS lon, COUNT(*) AS n FROM cube WHERE CAST(lon AS INT) % 180 = 0 AND CAST(lat AS INT) % 180 = 0 GROUP BY 1, 2""")
def subsample(spark, sf_dir):
    """P15."""
    c = cube(spark, sf_dir).withColumn("lon", F.col("lon") + 360.0000001)
    return gr.subsample_grid(c, 180, expected=(1, 2)).groupBy("lat", "lon").agg(F.count("*").alias("n"))


_T = f"""WITH {HIND}, t AS (SELECT lead_ix, lon, quantile_cont(value, 0.33) AS t33, quantile_cont(value, 0.66) AS t66 FROM hind GROUP BY 1, 2)"""


@query(_T + " SELECT lead_ix, lon, ROUND(t33, 6) AS t33, ROUND(t66, 6) AS t66 FROM t")
def terciles(spark, sf_dir):
    """A15."""
    return te.terciles(hindcast(spark, sf_dir), ["lead_ix", "lon"]).select("lead_ix", "lon", _r("t33", 6), _r("t66", 6))


_LAST = """, d AS (SELECT lead_ix, lon, init_date, AVG(value) AS value FROM hind GROUP BY 1, 2, 3), l AS (SELECT lead_ix, lon, arg_max(value, init_date) AS value FROM d GROUP BY 1, 2)"""


def _daily(spark, sf_dir):
    return hindcast(spark, sf_dir).groupBy("lead_ix", "lon", "init_date").agg(F.avg("value").alias("value"))


@query(_T + _LAST + """ SELECT lead_ix, lon, category, CASE WHEN (category = 'bn' AND value < t33) OR (category = 'an' AND value >= t66) OR (category = 'nn' AND NOT value < t33 AND NOT value >= t66) THEN 100.0 ELSE 0.0 END::DOUBLE AS percent
FROM l JOIN t USING (lead_ix, lon) CROSS JOIN (VALUES ('bn'), ('nn'), ('an')) c(category)""")
def tercile_category(spark, sf_dir):
    """A16."""
    keys = ["lead_ix", "lon"]
    return te.tercile_category(te.latest(_daily(spark, sf_dir), keys), te.terciles(hindcast(spark, sf_dir), keys), keys)


@query(_T + _LAST + ", m AS (SELECT lead_ix, lon, AVG(value) AS mean FROM hind GROUP BY 1, 2) SELECT lead_ix, lon, ROUND(value - mean, 6) AS value FROM l JOIN m USING (lead_ix, lon)")
def raw_anomaly(spark, sf_dir):
    """A17."""
    return te.raw_anomaly(_daily(spark, sf_dir), hindcast(spark, sf_dir), ["lead_ix", "lon"]).select("lead_ix", "lon", _r("value", 6))


@query(f"""WITH {HIND} SELECT model, lon, CASE lead_ix WHEN 0 THEN 'bn' WHEN 1 THEN 'nn' ELSE 'an' END AS category, ROUND(100 * AVG(value / 50), 6) AS value FROM hind WHERE lead_ix < 3 GROUP BY 1, 2, 3""")
def standard_probability(spark, sf_dir):
    """A18."""
    p = hindcast(spark, sf_dir).where("lead_ix < 3").groupBy("model", "lon", F.col("lead_ix").cast("string").alias("category")).agg(F.avg(F.col("value") / 50).alias("value"))
    return te.standardize_prob(p).select("model", "lon", "category", _r("value", 6))


@query("""SELECT event_type, COUNT(value) AS finite, 1.0::DOUBLE AS finite_share, MIN(value) AS min, MAX(value) AS max, ROUND(AVG(value), 6) AS mean, ROUND(stddev_pop(value), 6) AS std,
ROUND(quantile_cont(value, 0.1), 6) AS p10, ROUND(quantile_cont(value, 0.5), 6) AS p50, ROUND(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY 1""")
def describe_events(spark, sf_dir):
    """A11."""
    d = te.describe_field(table(spark, sf_dir, "events"), ["event_type"])
    return d.select("event_type", "finite", "finite_share", "min", "max", _r("mean", 6), _r("std", 6), _r("p10", 6), _r("p50", 6), _r("p90", 6))


@query(f"""WITH {CUBE}, m AS (SELECT model, var, lat, lon, lead_ix, AVG(value) AS value FROM cube GROUP BY 1, 2, 3, 4, 5), l AS (SELECT * FROM (VALUES (1, 0, 7), (2, 7, 14)) t(week, low, high))
SELECT model, var, lat, lon, CAST(week AS INT) AS week, ROUND(SUM(value * 86400), 2) AS value FROM m JOIN l ON lead_ix + 0.5 BETWEEN low + 0.5 AND high + 0.5 GROUP BY 1, 2, 3, 4, 5""")
def weekly_total(spark, sf_dir):
    """A14."""
    c = cube(spark, sf_dir).drop("init_date").withColumn("lead_days", F.col("lead_ix") + 0.5)
    leads = spark.sql("SELECT * FROM VALUES (1, 0, 7), (2, 7, 14) AS t(week, low, high)")
    return wk.weekly_total(c, leads).select("model", "var", "lat", "lon", "week", _r("value", 2))


@query(f"""WITH {HIND}, d AS (SELECT init_date AS day, lat, lon, AVG(value) AS value FROM hind WHERE init_date <> DATE '1996-03-20' GROUP BY 1, 2, 3),
s AS (SELECT week, DATE '1996-03-01' + CAST(range AS INT) AS day FROM (VALUES (1, 0), (2, 7), (3, 14)) t(week, low) CROSS JOIN range(0, 7) r WHERE true),
s2 AS (SELECT week, DATE '1996-03-01' + low + CAST(range AS INT) AS day FROM (VALUES (1, 0), (2, 7), (3, 14)) t(week, low) CROSS JOIN range(0, 7))
SELECT CAST(week AS INT) AS week, lat, lon, ROUND(SUM(value), 6) AS value FROM d JOIN s2 USING (day) WHERE week IN (SELECT week FROM s2 WHERE day IN (SELECT day FROM d) GROUP BY 1 HAVING COUNT(DISTINCT day) = 7) GROUP BY 1, 2, 3""")
def weekly_observations(spark, sf_dir):
    """A week with a missing day is left out."""
    daily = hindcast(spark, sf_dir).where("init_date <> DATE '1996-03-20'").groupBy(F.col("init_date").alias("day"), "lat", "lon").agg(F.avg("value").alias("value"))
    leads = spark.sql("SELECT * FROM VALUES (1, 0, 6), (2, 7, 13), (3, 14, 20) AS t(week, low, high)")
    return wk.weekly_obs(daily, "1996-03-01", leads).select("week", "lat", "lon", _r("value", 6))


@query(f"""WITH {CUBE}, t AS (SELECT model, var, MIN(lead_ix) AS lo, MAX(lead_ix) AS hi FROM cube WHERE lead_ix BETWEEN 4 AND 20 AND value IS NOT NULL GROUP BY 1, 2)
SELECT c.model, c.var, member, lead_ix, lat, lon, CASE WHEN lead_ix BETWEEN 4 AND 20 AND lead_ix <> 9 THEN value END AS value FROM cube c JOIN t USING (model, var) WHERE lead_ix BETWEEN lo AND hi""")
def trimmed_leads(spark, sf_dir):
    """outer empty leads go, the gap stays."""
    inside = F.col("lead_ix").between(4, 20) & (F.col("lead_ix") != 9)
    c = cube(spark, sf_dir).withColumn("value", F.when(inside, F.col("value")))
    return qu.trim_empty_leads(c).select("model", "var", "member", "lead_ix", "lat", "lon", "value")


@query(f"""WITH {CUBE}, m AS (SELECT model, median(value) AS med FROM (SELECT model, lead_ix, lat, lon, AVG(value) AS value FROM cube WHERE var = 'tas' GROUP BY 1, 2, 3, 4) GROUP BY 1),
e AS (SELECT model, var, lead_ix, lat, lon, AVG(value) AS value FROM cube GROUP BY 1, 2, 3, 4, 5)
SELECT model, var, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM e LEFT JOIN m USING (model) WHERE var <> 'tas' OR med BETWEEN 180 AND 278 GROUP BY 1, 2""")
def plausible_models(spark, sf_dir):
    """F3."""
    e = an.ensemble_mean(cube(spark, sf_dir).drop("init_date", "valid_date"))
    return qu.plausible_median(e, high=278).groupBy("model", "var").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
