"""Queries of catalogs, worklists, configuration tables, validation, archive upkeep and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as ca
from ..operators import archive as ar
from ..operators import normalise as no
from ..operators import quality as qu
from ..operators import thresholds as th
from ..operators import validation as va
from ..sources import catalog as ct
from ..sources import cube as cu
from ..streaming.landing import crossing_counts
from .fixtures import CAT, CUBE, catalog, cube, table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return keep


DAY = "1998-06-15"
_IN = "init_date BETWEEN DATE '{0}' - {1} AND DATE '{0}' - {2}"


@query(f"WITH {CAT} SELECT path, var, 'G' AS \"group\", model, 'forecast' AS kind, init_date FROM files")
def parsed_catalog(spark, sf_dir):
    """S4."""
    return ct.parse_catalog(catalog(spark, sf_dir).select("path")).select("path", "var", "group", "model", "kind", "init_date")


@query(f"""WITH {CAT} SELECT model, var, model AS name, init_date, path FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model, var ORDER BY init_date DESC, path) AS n FROM files
WHERE {_IN.format(DAY, 7, 1)}) WHERE n = 1""")
def newest_init(spark, sf_dir):
    """S5."""
    return ct.newest_init(catalog(spark, sf_dir), DAY)


@query(f"""WITH {CAT}, c AS (SELECT * FROM (VALUES ('A', 'G-M1', 0), ('A', 'G-M2', 1), ('B', 'G-M3', 0)) t(model, name, cand_ix))
SELECT model, var, name, init_date, path FROM (SELECT c.model, var, name, init_date, path, ROW_NUMBER() OVER (PARTITION BY c.model, var ORDER BY init_date DESC, cand_ix, path) AS n
FROM files f JOIN c ON c.name = f.model WHERE {_IN.format(DAY, 7, 1)}) WHERE n = 1""")
def newest_init_of_candidates(spark, sf_dir):
    """S5, F9 candidates."""
    c = spark.sql("SELECT * FROM VALUES ('A', 'G-M1', 0), ('A', 'G-M2', 1), ('B', 'G-M3', 0) AS t(model, name, cand_ix)")
    return ct.newest_init(catalog(spark, sf_dir), DAY, candidates=c)


@query(f"""WITH {CAT}, n AS (SELECT model, var, init_date, path FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model, var ORDER BY init_date DESC, path) AS n FROM files
WHERE {_IN.format(DAY, 2, 0)}) WHERE n = 1) SELECT e.model, e.var, init_date, path, path IS NOT NULL AS ok FROM (SELECT DISTINCT model, var FROM files) e LEFT JOIN n USING (model, var)""")
def presence(spark, sf_dir):
    """S6, S7, V1."""
    c = catalog(spark, sf_dir)
    return va.presence(c.select("model", "var").distinct(), c, DAY, 3)


@query(f"""WITH {CAT} SELECT name, url, init_date AS day, CAST(ROW_NUMBER() OVER (ORDER BY init_date DESC, name DESC) AS INT) AS rank FROM
(SELECT DISTINCT 'x-' || var || '_' || model || '_' || strftime(init_date, '%Y%m%d') || '.nc' AS name, 'http://h/' || var AS url, init_date FROM files WHERE model <> 'G-M0')
WHERE url = 'http://h/v1' AND init_date BETWEEN DATE '2000-06-06' AND DATE '2000-06-15'""")
def listing_candidates(spark, sf_dir):
    """S7, S8, D7."""
    c = catalog(spark, sf_dir)
    ends = F.when(F.col("model") == "G-M0", ".txt").otherwise(".nc")
    name = F.concat(F.lit("x-"), F.col("var"), F.lit("_"), F.col("model"), F.lit("_"), F.date_format("init_date", "yyyyMMdd"), ends)
    listing = c.select(name.alias("name"), F.concat(F.lit("http://h/"), F.col("var")).alias("url")).distinct()
    return ct.filter_listing(listing, "v1", ct.lookback_dates(spark, "2000-06-15", 10)).select("name", "url", "day", "rank")


@query(f"""WITH {CAT} SELECT DISTINCT init_date AS day FROM files WHERE model = 'G-M1' AND init_date IN (SELECT init_date FROM files WHERE model = 'G-M2')
AND init_date NOT IN (SELECT init_date FROM files WHERE model = 'G-M3')""")
def fetch_plan(spark, sf_dir):
    """S9."""
    c = catalog(spark, sf_dir).withColumnRenamed("init_date", "day")
    m = lambda x: c.where(F.col("model") == x)
    return ct.plan_fetch(m("G-M1"), m("G-M2"), m("G-M3"))


_FILES = "mem AS (SELECT DISTINCT l_returnflag AS model, CAST(o_orderdate AS DATE) AS init_date, l_linestatus AS var, CAST(l_linenumber AS INT) AS member FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _member_files(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(F.col("l_returnflag").alias("model"), F.col("o_orderdate").cast("date").alias("init_date"), F.col("l_linestatus").alias("var"), F.col("l_linenumber").cast("int").alias("member")).distinct()


@query(f"""WITH {_FILES}, n AS (SELECT model, init_date, COUNT(DISTINCT var) AS a FROM mem GROUP BY 1, 2) SELECT m.model, m.init_date, member FROM mem m JOIN n USING (model, init_date) GROUP BY 1, 2, 3, a HAVING COUNT(DISTINCT var) = a""")
def complete_members(spark, sf_dir):
    """S12."""
    return ct.complete_members(_member_files(spark, sf_dir))


@query(f"""WITH {_FILES} SELECT model, init_date, member FROM (SELECT DISTINCT model, init_date, member FROM mem) EXCEPT (SELECT model, init_date, member FROM mem GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT var) = 2)""")
def members_to_fetch(spark, sf_dir):
    """S12."""
    m = _member_files(spark, sf_dir)
    return ct.members_to_fetch(m.select("model", "init_date", "member").distinct(), ct.complete_members(m, 2))


@query(f"""WITH {_FILES} SELECT init_date, list_sort(list(DISTINCT member)) AS members FROM mem GROUP BY 1""".replace("list_sort(list(DISTINCT member))", "array_to_string(list_sort(list(DISTINCT member)), ',')"))
def members_by_init(spark, sf_dir):
    """Numeric order."""
    listing = _member_files(spark, sf_dir).select("init_date", F.concat(F.lit("ens"), F.col("member")).alias("name"))
    return ct.members_by_init(listing).select("init_date", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query(f"WITH {_FILES} SELECT DISTINCT init_date FROM mem WHERE member = 6")
def sentinel_dates(spark, sf_dir):
    """S10."""
    return ct.sentinel_dates(_member_files(spark, sf_dir), 6)


@query(f"""WITH {CAT} SELECT model, var, COUNT(*) AS n FROM files WHERE init_date >= DATE '1999-01-01' AND NOT (model = 'G-M2' AND extract(day FROM init_date) < 15) GROUP BY 1, 2""")
def mirror_counts(spark, sf_dir):
    """S13."""
    c = catalog(spark, sf_dir)
    remote = c.where((F.col("model") == "G-M2") & (F.dayofmonth("init_date") < 15)).select("path")
    return ct.mirror_counts(ct.mirror_diff(c, remote, "1999-01-01"))


@query(f"""WITH {CAT}, m AS (SELECT CASE WHEN model = 'G-M4' THEN '/old' || path WHEN model = 'G-M5' THEN path || '.tmp1' ELSE path END AS path, model, var, init_date FROM files)
SELECT CASE WHEN path LIKE '%.tmp%' THEN 'tmp' WHEN path NOT LIKE '/data/%' THEN 'outside_root' WHEN model IN ('G-M0', 'G-M1') THEN 'not_mirrored' WHEN init_date >= DATE '2000-01-01' THEN 'missing_locally' ELSE 'send' END AS status, COUNT(*) AS n FROM m GROUP BY 1""")
def resend_counts(spark, sf_dir):
    """S14, A19."""
    c = catalog(spark, sf_dir)
    path = F.when(F.col("model") == "G-M4", F.concat(F.lit("/old"), F.col("path"))).when(F.col("model") == "G-M5", F.concat(F.col("path"), F.lit(".tmp1"))).otherwise(F.col("path"))
    manifest = c.select(path.alias("path"))
    allowed = c.where(~F.col("model").isin("G-M0", "G-M1")).select("model", "var")
    jobs = ct.resend_jobs(manifest.unionByName(manifest), "/data", allowed, c.where("init_date < DATE '2000-01-01'"))
    return va.status_counts(jobs)


@query(f"""WITH {CAT} SELECT model, path, CAST(ceil(ROW_NUMBER() OVER (PARTITION BY model ORDER BY path) / 100.0) AS INT) AS batch, CAST(ceil(COUNT(*) OVER (PARTITION BY model) / 100.0) AS INT) AS batches FROM files""")
def batches(spark, sf_dir):
    """S15."""
    return ct.chunk(catalog(spark, sf_dir).select("model", "path"), 100, keys=["model"])


@query(f"""WITH {CAT} SELECT model, name, var_ix FROM (SELECT model, path AS name, CASE var WHEN 'v3' THEN 0 WHEN 'v1' THEN 1 ELSE 2 END AS var_ix,
ROW_NUMBER() OVER (PARTITION BY model ORDER BY CASE var WHEN 'v3' THEN 0 WHEN 'v1' THEN 1 ELSE 2 END, path) AS n FROM files) WHERE n <= 25""")
def first_files_per_model(spark, sf_dir):
    """S16 (the limit is the feature)."""
    c = catalog(spark, sf_dir).select("model", F.col("path").alias("name"), F.when(F.col("var") == "v3", 0).when(F.col("var") == "v1", 1).otherwise(2).alias("var_ix"))
    return ct.limit_per_model(c, 25)


@query(f"WITH {CAT} SELECT model, init_date FROM (SELECT model, init_date, DENSE_RANK() OVER (PARTITION BY model ORDER BY init_date DESC) AS n FROM (SELECT DISTINCT model, init_date FROM files)) WHERE n <= 4")
def latest_starts(spark, sf_dir):
    """W5."""
    return ct.latest_starts(catalog(spark, sf_dir))


@query(f"""WITH {CUBE} SELECT model, var, COUNT(DISTINCT member) AS n_member, COUNT(DISTINCT lead_ix) AS n_lead_ix, 0::BIGINT AS n_level, COUNT(DISTINCT lat) AS n_lat, COUNT(DISTINCT lon) AS n_lon,
CAST(MAX(init_date) AS VARCHAR) AS starts FROM cube GROUP BY 1, 2""")
def cube_profile(spark, sf_dir):
    """S17."""
    p = cu.cube_profile(cube(spark, sf_dir).withColumn("level", F.lit(None).cast("int")))
    return p.withColumn("starts", F.array_join(F.col("starts").cast("array<string>"), ","))


_PAR = f"""WITH {CAT}, p AS (SELECT *, var AS "schema" FROM files WHERE model <> 'G-M1'), s AS (SELECT *, CASE WHEN extract(day FROM init_date) = 7 THEN 'odd' ELSE var END AS "schema" FROM files WHERE model <> 'G-M2'),
par AS (SELECT model, var, init_date, CASE WHEN s.path IS NULL THEN 'primary_only' WHEN p.path IS NULL THEN 'shadow_only' ELSE 'both' END AS presence,
  CASE WHEN s.path IS NOT NULL AND p.path IS NOT NULL THEN p."schema" = s."schema" END AS schema_ok FROM p FULL JOIN s USING (model, var, init_date))"""


def _parity(spark, sf_dir):
    c = catalog(spark, sf_dir)
    odd = F.when(F.dayofmonth("init_date") == 7, F.lit("odd")).otherwise(F.col("var"))
    return ct.parity(c.where("model <> 'G-M1'").withColumn("schema", F.col("var")), c.where("model <> 'G-M2'").withColumn("schema", odd))


@query(_PAR + " SELECT model, var, init_date, presence, CASE WHEN schema_ok THEN 'same' WHEN NOT schema_ok THEN 'other' ELSE 'unknown' END AS \"schema\" FROM par")
def parity(spark, sf_dir):
    """J11."""
    schema = F.when(F.col("schema_ok"), "same").when(~F.col("schema_ok"), "other").otherwise("unknown")
    return _parity(spark, sf_dir).select("model", "var", "init_date", "presence", schema.alias("schema"))


@query(_PAR + """ SELECT COUNT(*) FILTER (presence = 'both') AS "both", COUNT(*) FILTER (presence = 'primary_only') AS primary_only, COUNT(*) FILTER (presence = 'shadow_only') AS shadow_only,
COUNT(*) FILTER (schema_ok) AS schema_ok, COUNT(*) FILTER (NOT schema_ok) AS schema_mismatch, COUNT(*) FILTER (schema_ok IS NULL) AS schema_unavailable FROM par""")
def parity_counts(spark, sf_dir):
    """V4, A19."""
    return va.parity_counts(_parity(spark, sf_dir))


@query(f"""WITH {CAT} SELECT DISTINCT model, var, init_date FROM files WHERE NOT (init_date < DATE '1997-01-01' OR var = 'v2')""")
def archive_gap(spark, sf_dir):
    """J12."""
    c = catalog(spark, sf_dir)
    return ct.archive_diff(c, c.where("init_date < DATE '1997-01-01' OR var = 'v2'"))


@query("""SELECT o_orderpriority AS entry, 'climo' AS stage, CAST(extract(year FROM o_orderdate) AS INT) AS first_year, CAST(extract(year FROM o_orderdate) AS INT) AS last_year, COUNT(*) AS n FROM orders
WHERE o_orderpriority <> '2-HIGH' AND extract(year FROM o_orderdate) % 2 = 0 GROUP BY 1, 3""")
def already_built(spark, sf_dir):
    """J14."""
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    e = o.select(F.col("o_orderpriority").alias("entry"), F.lit("climo").alias("stage"), year.alias("first_year"), year.alias("last_year"))
    m = e.where("entry <> '2-HIGH' AND first_year % 2 = 0").groupBy("stage", "first_year", "last_year").agg(F.collect_set("entry").alias("entries"))
    return th.already_built(e, m).groupBy("entry", "stage", "first_year", "last_year").agg(F.count("*").alias("n"))


@query(f"""WITH {CAT}, m AS (SELECT DISTINCT model AS label, var FROM files WHERE init_date < DATE '1997-01-01' AND (var <> 'v2' OR model = 'G-M2')),
o AS (SELECT DISTINCT 'M1' AS key, var FROM files WHERE model = 'G-M1' AND extract(day FROM init_date) = 3 AND var < 'v4' UNION SELECT 'G-M4', var FROM files WHERE model = 'G-M4' AND var > 'v3'),
v AS (SELECT DISTINCT model AS label, var FROM files WHERE init_date >= DATE '1997-01-01' AND NOT (model = 'G-M3' AND var <> 'v5'))
SELECT label, var FROM (SELECT DISTINCT m.label, CASE WHEN m.label IN ('G-M1', 'G-M4') THEN o.var ELSE m.var END AS var FROM m LEFT JOIN o ON o.key = m.label OR 'G-' || o.key = m.label)
JOIN v USING (label, var) WHERE label <> (SELECT MAX(model) FROM files)""")
def resolved_models(spark, sf_dir):
    """F8: variables from early files, overrides by name and by label, known ones from later files, the last model skipped."""
    c = catalog(spark, sf_dir)
    lists = lambda df, *keys: df.groupBy(*keys).agg(F.collect_set("var").alias("vars"))
    m = lists(c.where("init_date < DATE '1997-01-01' AND (var <> 'v2' OR model = 'G-M2')"), F.col("model").alias("label"), F.substring("model", 3, 9).alias("name"))
    by_name = lists(c.where("model = 'G-M1' AND day(init_date) = 3 AND var < 'v4'"), F.lit("M1").alias("key"))
    by_label = lists(c.where("model = 'G-M4' AND var > 'v3'"), F.lit("G-M4").alias("key"))
    v = c.where("init_date >= DATE '1997-01-01' AND NOT (model = 'G-M3' AND var <> 'v5')").select(F.col("model").alias("label"), "var").distinct()
    return ct.resolve_models(m, v, by_name.unionByName(by_label), c.agg(F.max("model").alias("label")))


@query(f"""WITH {CAT}, r AS (SELECT DISTINCT model FROM files UNION ALL SELECT 'SUBC-MME') SELECT model, CAST(ROW_NUMBER() OVER (ORDER BY CASE WHEN model = 'SUBC-MME' THEN 3 WHEN model IN ('G-M3', 'G-M1') THEN 0 WHEN model = 'G-M5' THEN 1 ELSE 2 END,
CASE model WHEN 'G-M3' THEN 1 WHEN 'G-M1' THEN 2 ELSE 0 END, model) AS INT) AS rank FROM r""")
def model_order(spark, sf_dir):
    """F10."""
    names = catalog(spark, sf_dir).select("model").unionByName(spark.range(1).select(F.lit("SUBC-MME").alias("model")))
    return ct.model_order(names, ["G-M3", "G-M1", "G-M9"], ["G-M5"])


@query(f"""WITH {CAT} SELECT model, CASE WHEN model = 'G-M1' THEN 'direct' WHEN model = 'G-M2' THEN 'direct_esrl' ELSE 'iridl' END AS source, CASE WHEN model = 'G-M1' THEN 'gmao' WHEN model = 'G-M2' THEN 'esrl' ELSE 'iridl' END AS provider FROM (SELECT DISTINCT model FROM files)""")
def routed_sources(spark, sf_dir):
    """F12."""
    o = spark.sql("SELECT * FROM VALUES ('G-M1', 'direct'), ('G-M2', 'direct_esrl') AS t(model, source)")
    return ct.route_sources(catalog(spark, sf_dir).select("model").distinct(), "iridl", o, spark.sql("SELECT 'G-M1' AS model, 'gmao' AS provider"))


@query(f"""WITH {CAT} SELECT model, CASE WHEN model = 'G-M1' THEN 'one' WHEN model = 'G-M2' THEN 'two' ELSE substr(model, 3) END AS local,
CASE WHEN model = 'G-M1' THEN 'G-one,G-M1' WHEN model = 'G-M2' THEN 'G-two,G-M2' ELSE model END AS candidates FROM (SELECT DISTINCT model FROM files)""")
def local_names(spark, sf_dir):
    """F9."""
    m = catalog(spark, sf_dir).select(F.lit("G").alias("group"), F.substring("model", 3, 9).alias("name")).distinct()
    n = ct.model_names(m, spark.sql("SELECT * FROM VALUES ('G-M1', 'one'), ('M2', 'two') AS t(key, local)"))
    return n.withColumn("candidates", F.array_join("candidates", ","))


@query(f"""WITH {CAT}, m AS (SELECT DISTINCT var AS predictor, model FROM files) SELECT predictor, model, CAST(lead AS INT) AS lead FROM (SELECT predictor, model FROM m WHERE predictor <> 'v1' UNION SELECT 'v1', 'own') CROSS JOIN (VALUES (1), (2)) t(lead)""")
def predictor_files(spark, sf_dir):
    """F11."""
    c = catalog(spark, sf_dir).groupBy(F.col("var").alias("predictor")).agg(F.collect_set("model").alias("models"))
    none = F.lit(None).cast("array<string>")
    specs = c.withColumns({"explicit": F.when(F.col("predictor") == "v1", F.array(F.lit("own"))), "cli": none, "group": none, "default": F.array(F.lit("x"))})
    return ct.predictor_specs(specs, spark.sql("SELECT * FROM VALUES 1, 2 AS t(lead)"))


# ------------------------------------------------------------------ archive

_ARC = f"""WITH {CUBE}, land AS (SELECT model, var, init_date + (member - 1) AS init_date, lead_ix, lat, lon, CASE WHEN var = 'tas' AND member = 5 THEN NULL ELSE value END AS value FROM cube),
arc AS (SELECT model, var, init_date, lead_ix, lat, lon, CASE WHEN var = 'pr' AND init_date = (SELECT MAX(init_date) - 3 FROM land l2 WHERE l2.model = land.model) THEN NULL ELSE value END AS value
  FROM land WHERE init_date < (SELECT MAX(init_date) - 1 FROM land l3 WHERE l3.model = land.model) AND NOT (var = 'tas' AND model LIKE 'A-%'))"""


def _land(spark, sf_dir):
    """Each member as a start of its own: seven starts of every model; one variable misses one."""
    c = cube(spark, sf_dir).withColumn("init_date", F.date_add("init_date", F.col("member") - 1))
    c = c.withColumn("value", F.when(~((F.col("var") == "tas") & (F.col("member") == 5)), F.col("value")))
    return c.select("model", "var", "init_date", F.col("init_date").cast("timestamp_ntz").alias("init_ts"), "lead_ix", "lat", "lon", "value")


def _archive(land):
    """The landing table as archived before: without its last two starts and one model's tas, with an empty pr start."""
    newest = land.groupBy("model").agg(F.max("init_date").alias("_m"))
    a = land.join(F.broadcast(newest), "model").where((F.col("init_date") < F.date_sub("_m", 1)) & ~((F.col("var") == "tas") & F.col("model").startswith("A-")))
    gap = (F.col("var") == "pr") & (F.col("init_date") == F.date_sub("_m", 3))
    return a.withColumn("value", F.when(~gap, F.col("value"))).select(*land.columns)


_SLOTS = """, newest AS (SELECT model, MAX(init_date) AS mark FROM arc GROUP BY 1), plan AS (
SELECT model, var, init_date, COUNT(*) AS cells, 'append' AS action FROM land JOIN newest USING (model) WHERE init_date > mark GROUP BY 1, 2, 3
UNION ALL SELECT model, var, init_date, COUNT(*), 'add_var' FROM land WHERE (model, init_date) IN (SELECT model, init_date FROM arc) AND (model, var) NOT IN (SELECT model, var FROM arc) GROUP BY 1, 2, 3
UNION ALL SELECT model, var, init_date, COUNT(*), 'backfill' FROM land l JOIN newest USING (model) WHERE init_date BETWEEN mark - 3 AND mark AND (model, var) IN (SELECT model, var FROM arc)
  AND NOT EXISTS (SELECT 1 FROM arc a WHERE a.model = l.model AND a.var = l.var AND a.init_date = l.init_date AND a.value IS NOT NULL) GROUP BY 1, 2, 3 HAVING COUNT(value) > 0)"""


@query(_ARC + _SLOTS + " SELECT model, var, init_date, cells, action FROM plan")
def sync_plan(spark, sf_dir):
    """M2, M3, M5, M6 as a dry run."""
    land = _land(spark, sf_dir)
    return ar.sync_plan(land, _archive(land)).select("model", "var", "init_date", "cells", "action")


@query(_ARC + """ SELECT s.model, v.var, s.init_date, CASE WHEN COUNT(a.value) > 0 THEN 'filled' ELSE 'missing' END AS state FROM (SELECT DISTINCT model, init_date FROM arc) s
JOIN (SELECT DISTINCT model, var FROM arc) v USING (model) LEFT JOIN arc a ON a.model = s.model AND a.var = v.var AND a.init_date = s.init_date GROUP BY 1, 2, 3""")
def slot_states(spark, sf_dir):
    """M4."""
    return ar.fill_slots(_archive(_land(spark, sf_dir))).select("model", "var", "init_date", "state")


@query(_ARC + """, r AS (SELECT * FROM land WHERE NOT (var = 'tas' AND init_date = (SELECT MAX(init_date) FROM land l2 WHERE l2.model = land.model)))
SELECT model, 'tas' AS var, CAST(1 AS BIGINT) AS gap, MAX(init_date) AS missing_ts FROM r GROUP BY 1""")
def lagging_variables(spark, sf_dir):
    """M7."""
    land = _land(spark, sf_dir)
    newest = land.groupBy("model").agg(F.max("init_date").alias("_m"))
    r = land.join(newest, "model").where(~((F.col("var") == "tas") & (F.col("init_date") == F.col("_m"))))
    return ar.lagging(r).select("model", "var", "gap", F.col("missing_ts").cast("date").alias("missing_ts"))


@query(_ARC + " SELECT model, var, init_date, COUNT(*) AS cells, ROUND(SUM(value), 4) AS total FROM land WHERE var = 'tas' AND init_date = (SELECT MAX(init_date) FROM land l2 WHERE l2.model = land.model) GROUP BY 1, 2, 3")
def repaired_gaps(spark, sf_dir):
    """M7: rows that close the gap."""
    land = _land(spark, sf_dir)
    newest = land.groupBy("model").agg(F.max("init_date").alias("_m"))
    r = land.join(newest, "model").where(~((F.col("var") == "tas") & (F.col("init_date") == F.col("_m")))).drop("_m")
    return ar.repair_gaps(r, land).groupBy("model", "var", "init_date").agg(F.count("*").alias("cells"), F.round(F.sum("value"), 4).alias("total"))


def _leads(spark, sf_dir):
    """A cube with labels: right for A and N models, shifted by half a day for R ones, whole numbers for tas."""
    c = cube(spark, sf_dir).withColumn("kind", F.lit("forecast"))
    label = F.when(F.col("var") == "tas", F.col("lead_ix")).when(F.col("model").startswith("R"), F.col("lead_ix") + 1.0).otherwise(F.col("lead_ix") + 0.5)
    return c.withColumn("lead_days", label.cast("float"))


def _audit(spark, sf_dir, c):
    models = c.select("model").distinct().select("model", F.lit(0.5).alias("first"), F.lit(45).alias("n"))
    return ar.audit_leads(ar.lead_files(c), ar.canonical_leads(models))


_AUD = f"""WITH {CUBE}, aud AS (SELECT model, var, CASE WHEN COUNT(DISTINCT lead_ix) <> 45 THEN 'length_mismatch' WHEN var = 'tas' OR model LIKE 'R%' THEN 'relabel' ELSE 'ok' END AS status FROM cube GROUP BY 1, 2)"""


@query(_AUD + " SELECT model, var, status FROM aud")
def lead_audit(spark, sf_dir):
    """M9."""
    return _audit(spark, sf_dir, _leads(spark, sf_dir)).select("model", "var", "status")


@query(_AUD + " SELECT model, var, lead_ix, ROUND(CASE WHEN status <> 'length_mismatch' THEN lead_ix + 0.5 WHEN var = 'tas' THEN lead_ix WHEN model LIKE 'R%' THEN lead_ix + 1.0 ELSE lead_ix + 0.5 END, 4)::DOUBLE AS lead_days, COUNT(*) AS n FROM cube JOIN aud USING (model, var) GROUP BY 1, 2, 3, 4")
def relabelled(spark, sf_dir):
    """M10."""
    c = _leads(spark, sf_dir)
    return ar.relabel_leads(c, _audit(spark, sf_dir, c)).groupBy("model", "var", "lead_ix", F.col("lead_days").cast("double").alias("lead_days")).agg(F.count("*").alias("n"))


@query(_AUD + " SELECT model, var, lead_ix, ROUND(CASE WHEN var = 'pr' AND model LIKE 'R%' THEN lead_ix + 1.0 ELSE lead_ix + 0.5 END, 4)::DOUBLE AS lead_days, COUNT(*) AS n FROM cube GROUP BY 1, 2, 3, 4")
def shifted_leads(spark, sf_dir):
    """M11."""
    return ar.shift_leads(_leads(spark, sf_dir)).groupBy("model", "var", "lead_ix", F.col("lead_days").cast("double").alias("lead_days")).agg(F.count("*").alias("n"))


@query(_AUD + " SELECT model, var, lead_ix, ROUND(1.5 + lead_ix, 4)::DOUBLE AS lead_days, COUNT(*) AS n FROM cube WHERE model LIKE 'N-O' GROUP BY 1, 2, 3, 4")
def replaced_leads(spark, sf_dir):
    """M8."""
    c = _leads(spark, sf_dir).where("model = 'N-O'")
    n = c.agg((F.max("lead_ix") + 1).alias("n")).select(F.lit("N-O").alias("model"), F.lit(1.5).alias("first"), (F.lit(0.5) + F.col("n")).alias("last"), "n")
    return ar.replace_leads(c, n).groupBy("model", "var", "lead_ix", F.col("lead_days").cast("double").alias("lead_days")).agg(F.count("*").alias("n"))


@query(f"""WITH {CUBE}, o AS (SELECT model, var, init_date, lead_ix, lat, lon, member, CASE WHEN member = 2 THEN NULL ELSE value END AS value FROM cube WHERE member <= 3), n AS (SELECT model, var, init_date, lead_ix, lat, lon, member, value + 1000 AS value FROM cube WHERE member BETWEEN 2 AND 5),
m AS (SELECT * FROM o WHERE member <> 2 UNION ALL SELECT * FROM n WHERE member <> 3)
SELECT model, var, member, COUNT(value) AS filled, SUM(value) AS total FROM m GROUP BY 1, 2, 3""")
def merged_members(spark, sf_dir):
    """M12, P20."""
    c = cube(spark, sf_dir).drop("valid_date")
    old = c.where("member <= 3").withColumn("value", F.when(F.col("member") != 2, F.col("value")))
    new = c.where("member BETWEEN 2 AND 5").withColumn("value", F.col("value") + 1000)
    return ar.merge_members(old, new).groupBy("model", "var", "member").agg(F.count("value").alias("filled"), F.sum("value").alias("total"))


# ------------------------------------------------------------------ normalisation


@query(f"""WITH {CUBE}, k AS (SELECT model, var, init_date, member, h, DENSE_RANK() OVER (PARTITION BY model, var, init_date ORDER BY h, member) AS nm FROM (SELECT DISTINCT model, var, init_date, member, CAST(lat AS INT) AS h FROM cube))
SELECT model, var, CAST(nm AS INT) AS member, COUNT(*) AS n, SUM(value) AS total FROM cube c JOIN k ON c.model = k.model AND c.var = k.var AND c.member = k.member AND CAST(c.lat AS INT) = k.h GROUP BY 1, 2, 3""".replace("SELECT model, var, CAST(nm", "SELECT c.model, c.var, CAST(nm"))
def folded_starts(spark, sf_dir):
    """Latitude stands for the start's hour."""
    c = cube(spark, sf_dir).withColumn("init_ts", F.timestamp_add("HOUR", F.col("lat").cast("int"), F.col("init_date").cast("timestamp_ntz")))
    return no.fold_starts(c).groupBy("model", "var", "member").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query(f"""WITH {CUBE} SELECT model, var, ROUND(SUM(CASE WHEN var = 'pr' AND model LIKE 'A%' THEN value / 86400 ELSE value END), 6) AS total FROM cube GROUP BY 1, 2""")
def rates(spark, sf_dir):
    """P12."""
    c = cube(spark, sf_dir).withColumn("units", F.when(F.col("model").startswith("A"), "kg m-2").when(F.col("model").startswith("N"), "kg m-2 s-1").otherwise(""))
    return no.convert_units(c, "rate").groupBy("model", "var").agg(F.round(F.sum("value"), 6).alias("total"))


@query(f"""WITH {CUBE} SELECT model, var, lead_ix, CASE WHEN model LIKE 'A%' THEN init_date + CAST(floor((lead_ix * 12 + 12) / 24.0) AS INT) ELSE init_date + lead_ix END AS valid_date, COUNT(*) AS n FROM cube GROUP BY 1, 2, 3, 4""")
def decoded_leads(spark, sf_dir):
    """P6."""
    hours = F.col("model").startswith("A")
    c = cube(spark, sf_dir).withColumns({"lead": F.when(hours, F.col("lead_ix") * 12.0 + 12).otherwise(F.col("lead_ix") + 0.5), "units": F.when(hours, "hours since").otherwise("days")})
    return no.decode_lead(c).groupBy("model", "var", "lead_ix", "valid_date").agg(F.count("*").alias("n"))


@query(f"""WITH {CUBE}, k AS (SELECT DISTINCT model, var, init_date, lead_ix, valid_date, lat, lon FROM cube WHERE model = 'A-F' AND lead_ix < 20)
SELECT model, var, member, COUNT(*) AS n, COUNT(value) AS filled FROM (SELECT k.model, k.var, m.member, c.value FROM k CROSS JOIN (SELECT CAST(range AS INT) AS member FROM range(1, 10)) m
LEFT JOIN cube c ON c.model = k.model AND c.var = k.var AND c.member = m.member AND c.lead_ix = k.lead_ix AND c.lat = k.lat AND c.lon = k.lon
UNION ALL SELECT model, var, member, value FROM cube WHERE model <> 'A-F') GROUP BY 1, 2, 3""")
def fixed_shape(spark, sf_dir):
    """P18."""
    c = cube(spark, sf_dir).withColumn("kind", F.lit("forecast"))
    return no.fix_shape(c, 20, 9, ("A-F",)).groupBy("model", "var", "member").agg(F.count("*").alias("n"), F.count("value").alias("filled"))


@query(f"""WITH {CUBE} SELECT model, var, lead_ix, lat, ROUND(AVG(value), 6) AS value FROM cube GROUP BY 1, 2, 3, 4""")
def merged_cells(spark, sf_dir):
    """Members and longitudes that snap to one cell become their mean."""
    c = cube(spark, sf_dir).select("model", "var", "lead_ix", "lat", (F.col("lon") * 1e-9).alias("lon"), "value")
    return no.merge_duplicate_cells(no.snap_grid(c)).select("model", "var", "lead_ix", "lat", F.round("value", 6).alias("value"))


@query(f"""WITH {CUBE}, m AS (SELECT model, var, member, lead_ix, lat, lon, CASE WHEN (member + CAST(lat AS INT)) % 3 <> 0 THEN value END AS value FROM cube)
SELECT model, var, member, lat, COUNT(*) AS n FROM m WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4""")
def without_empty_files(spark, sf_dir):
    """F1, F2."""
    c = cube(spark, sf_dir).withColumn("value", F.when(F.pmod(F.col("member") + F.col("lat").cast("int"), F.lit(3)) != 0, F.col("value")))
    return qu.drop_empty(c, ["model", "var", "member", "lat"]).groupBy("model", "var", "member", "lat").agg(F.count("*").alias("n"))


_REGIONAL = f"""WITH {CUBE}, c AS (SELECT model, var, member, lead_ix, 10 + lat / 10 + 2 * (lead_ix % 3) AS lat, 200 + lon / 90 + 4 * (member % 2) AS lon,
CASE WHEN (model LIKE 'R%' AND lon <> 90) OR (model LIKE 'A%' AND var = 'tas') THEN NULL ELSE value END AS value FROM cube),
g AS (SELECT model, var, MIN(member) AS m, MIN(lead_ix) AS l, list_sort(list_distinct(list(lat))) AS ys, list_sort(list_distinct(list(lon))) AS xs FROM c GROUP BY 1, 2),
s AS (SELECT c.model, c.var, {{}} AS inside, c.value FROM c JOIN g ON c.model = g.model AND c.var = g.var AND c.member = g.m AND c.lead_ix = g.l),
bad AS (SELECT model, var FROM s WHERE inside GROUP BY 1, 2 HAVING COUNT(value) = 0) SELECT c.model, c.var, COUNT(*) AS n, COUNT(value) AS filled FROM c WHERE (model, var) NOT IN (SELECT model, var FROM bad) GROUP BY 1, 2"""


def _regional(spark, sf_dir):
    """Grids of a few cells far from the equator: files with values outside the middle only, and files without any."""
    c = cube(spark, sf_dir)
    empty = (F.col("model").startswith("R") & (F.col("lon") != 90)) | (F.col("model").startswith("A") & (F.col("var") == "tas"))
    place = {"value": F.when(~empty, F.col("value")), "lat": 10 + F.col("lat") / 10 + 2 * (F.col("lead_ix") % 3), "lon": 200 + F.col("lon") / 90 + 4 * (F.col("member") % 2)}
    return c.withColumns(place).select("model", "var", "member", "lead_ix", "lat", "lon", "value")


def _kept(df):
    return df.groupBy("model", "var").agg(F.count("*").alias("n"), F.count("value").alias("filled"))


@query(_REGIONAL.format("list_contains(ys[GREATEST(1, len(ys) // 2 - 1) : len(ys) // 2 + 3], c.lat) AND list_contains(xs[GREATEST(1, len(xs) // 2 - 1) : len(xs) // 2 + 3], c.lon)"))
def without_empty_centres(spark, sf_dir):
    """F1 (a): the middle of each file's own grid."""
    return _kept(qu.drop_empty(_regional(spark, sf_dir), ["model", "var"], "centre"))


@query(_REGIONAL.format("(list_position(ys, c.lat) - 1) % GREATEST(1, len(ys) // 10) = 0 AND (list_position(xs, c.lon) - 1) % GREATEST(1, len(xs) // 10) = 0"))
def without_empty_strides(spark, sf_dir):
    """F1 (b): about ten by ten cells of each file's own grid."""
    return _kept(qu.drop_empty(_regional(spark, sf_dir), ["model", "var"], "strided"))


@query("""SELECT o_custkey AS model, CAST(o_orderdate AS DATE) AS day, MIN(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2""")
def first_of_duplicates(spark, sf_dir):
    """F7."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("model"), F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    return qu.keep_first(o, ["model", "day"], ["o_orderkey"])


@query(f"""WITH {CUBE} SELECT model, member, lead_ix, lat, lon, MAX(value) FILTER (var = 'pr') AS pr, MAX(value) FILTER (var = 'tas') AS tas FROM cube GROUP BY 1, 2, 3, 4, 5""")
def wide_variables(spark, sf_dir):
    """J9."""
    return no.widen_vars(cube(spark, sf_dir), ["pr", "tas"], "error").select("model", "member", "lead_ix", "lat", "lon", "pr", "tas")


@query("""SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) - CAST((isodow(o_orderdate) + 3) % 7 AS INT) AS thursday, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
CAST(dayofyear(('2000' || strftime(o_orderdate, '-%m-%d'))::DATE) AS INT) AS doy, strftime(DATE '1959-12-31' + CAST(dayofyear(o_orderdate) AS INT), '%m%d') AS label, COUNT(*) AS n FROM orders GROUP BY 1, 2, 3, 4, 5""")
def calendar(spark, sf_dir):
    """D1, D3, D5."""
    day = F.col("o_orderdate").cast("date")
    o = table(spark, sf_dir, "orders").select(day.alias("day"))
    d = F.col("day")
    o = o.select("day", ca.latest_thursday(d).alias("thursday"), ca.month_start(d).alias("month"), ca.mmdd_to_doy(ca.mmdd(d)).alias("doy"), ca.doy_to_mmdd(F.dayofyear(d)).alias("label"))
    return o.groupBy("day", "thursday", "month", "doy", "label").agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT user_id, value, date_trunc('day', ts) - (CAST(range AS INT) || ' days')::INTERVAL AS s FROM events CROSS JOIN range(0, 7))
SELECT strftime(s, '%Y-%m-%d') AS window_start, user_id, COUNT(*) FILTER (value > 20) AS crossings, COUNT(*) AS n FROM w GROUP BY 1, 2""")
def weekly_crossings(spark, sf_dir):
    """R2, W2 on real timestamps (the batch form of the stream)."""
    c = crossing_counts(table(spark, sf_dir, "events"), 20)
    return c.select(F.date_format("w.start", "yyyy-MM-dd").alias("window_start"), "user_id", "crossings", "n")
