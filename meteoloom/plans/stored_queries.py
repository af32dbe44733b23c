"""Queries that go through stored data: cubes, products, manifests, archives and landing folders.

Each writes to a folder of its own in the shared folder and reads from there.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import archive as ar
from ..operators import normalise as no
from ..operators import regrid as gr
from ..operators import validation as va
from ..operators import weekly as wk
from ..sources import catalog as ct
from ..sources import cube as cu
from ..sources import sinks as sk
from ..sources.snapshots import Archive, Conflict
from ..sources.working import scratch, store
from ..streaming.landing import crossing_stream, landing_stream
from .archive_queries import _ARC, _archive, _land
from .fixtures import CAT, CLIMO, CUBE, FCST, HIND, catalog, climo, cube, hindcast, table
from .product_queries import ANOM, WEEKLY, _weekly

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return keep


def _full(df, kind: str):
    """All columns of a stored cube."""
    more = {"kind": F.lit(kind), "init_ts": F.col("init_date").cast("timestamp_ntz"), "lead_days": (F.col("lead_ix") + 0.5).cast("float"), "valid_date": F.date_add("init_date", F.col("lead_ix")), "level": F.lit(None).cast("int")}
    return df.withColumns(more).select(*[x.split()[0] for x in cu.SCHEMA.split(", ")])


@query(f"""WITH {CUBE} SELECT model, init_date, lat, COUNT(*) AS n, COUNT(CASE WHEN lead_ix <> 7 THEN value END) AS filled, SUM(CASE WHEN lead_ix <> 7 THEN value END) AS total FROM cube
WHERE var = 'pr' AND model IN ('A-F', 'N-O') GROUP BY 1, 2, 3""")
def stored_cube(spark, sf_dir):
    """Written by partition, read with partition filters; NaN is missing."""
    root = scratch(spark, "cube")
    c = cube(spark, sf_dir).withColumn("value", F.when(F.col("lead_ix") == 7, float("nan")).otherwise(F.col("value")))
    cu.write_cube(_full(c, "forecast"), root)
    got = cu.read_cube(spark, root, "forecast", ["A-F", "N-O"], ["pr"])
    return got.groupBy("model", "init_date", "lat").agg(F.count("*").alias("n"), F.count("value").alias("filled"), F.sum("value").alias("total"))


@query(f"""WITH {HIND} SELECT model, CAST(date_trunc('month', init_date) AS DATE) AS init_date, COUNT(*) AS n, SUM(value) AS total FROM hind
WHERE extract(year FROM init_date) BETWEEN 1996 AND 1998 AND extract(month FROM init_date) <> 5 GROUP BY 1, 2""")
def stored_hindcast(spark, sf_dir):
    """Monthly starts of three years; those of May hold no value and drop out."""
    root = scratch(spark, "hindcast")
    h = hindcast(spark, sf_dir).withColumn("init_date", F.trunc("init_date", "month"))
    cu.write_cube(_full(h.withColumn("value", F.when(F.month("init_date") != 5, F.col("value"))), "hindcast"), root)
    return cu.read_hindcast(spark, root, 1996, 1998).groupBy("model", "init_date").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query(f"""WITH {CUBE}, {CLIMO}, m AS (SELECT var, lat, lon, value, DENSE_RANK() OVER (PARTITION BY var ORDER BY lead_ix) - 1 AS ix FROM climo WHERE model = 'N-O' AND lead_ix % 3 <> 1)
SELECT model, var, member, lead_ix, COUNT(*) AS n, ROUND(SUM(value), 3) AS total FROM (SELECT model, var, member, lead_ix, value FROM cube WHERE model = 'A-F'
UNION ALL SELECT 'mean', var, -1, CAST(ix AS INT), value FROM m) GROUP BY 1, 2, 3, 4""")
def hindcast_with_means(spark, sf_dir):
    """S3: a source of ensemble means has no member, and its leads count by position."""
    mean = climo(spark, sf_dir).where("model = 'N-O' AND lead_ix % 3 <> 1").withColumns({"model": F.lit("mean"), "init_date": F.lit(FCST).cast("date"), "lead_days": F.col("lead_ix") + 0.5})
    c = cu.add_ensemble_means(cube(spark, sf_dir).where("model = 'A-F'"), mean)
    return c.groupBy("model", "var", F.coalesce("member", F.lit(-1)).alias("member"), "lead_ix").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query(f"""WITH {CUBE}, {CLIMO}, {ANOM}, {WEEKLY} SELECT DATE '{FCST}' AS fcst_date, model, week, COUNT(*) AS n, COUNT(value) AS filled FROM
(SELECT model, week, value FROM wk UNION ALL SELECT 'SUBC-MME', week, AVG(value) FROM wk GROUP BY var, lat, lon, week) GROUP BY 2, 3""")
def product_files(spark, sf_dir):
    """The weekly product as stored by forecast date."""
    root = scratch(spark, "product")
    sk.write_product(wk.multi_model_mean(_weekly(spark, sf_dir)).select("model", "var", "lat", "lon", "week", "value"), root, FCST)
    return spark.read.parquet(root).groupBy("fcst_date", "model", "week").agg(F.count("*").alias("n"), F.count("value").alias("filled"))


@query(f"""WITH {CUBE}, {CLIMO}, {ANOM}, {WEEKLY} SELECT CASE WHEN lon < 180 THEN 'east' ELSE 'west' END AS region, week, CASE WHEN var = 'pr' THEN 'mm/week' ELSE 'native' END AS units,
CASE WHEN var = 'pr' THEN 'sum' ELSE 'mean' END AS aggregation, COUNT(*) AS n FROM wk GROUP BY 1, 2, 3, 4""")
def region_files(spark, sf_dir):
    """Weekly values as stored by region and week, with units."""
    root = scratch(spark, "regions")
    w = _weekly(spark, sf_dir).withColumn("region", F.when(F.col("lon") < 180, "east").otherwise("west"))
    sk.write_region_weekly(w.select("region", "model", "var", "lat", "lon", "week", "value"), root)
    return spark.read.parquet(root).groupBy("region", "week", "units", "aggregation").agg(F.count("*").alias("n"))


@query("""SELECT o_orderpriority AS entry, CASE WHEN o_orderkey % 2 = 0 THEN 'climo' ELSE 'percentile' END AS stage, CAST(extract(year FROM o_orderdate) AS INT) AS first_year, COUNT(*) AS n FROM orders GROUP BY 1, 2, 3""")
def manifest_round_trip(spark, sf_dir):
    """Appended twice, between lines that aren't JSON."""
    path = scratch(spark, "manifest")
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderpriority").alias("entry"), F.when(F.col("o_orderkey") % 2 == 0, "climo").otherwise("percentile").alias("stage"), F.year("o_orderdate").alias("first_year"), F.year("o_orderdate").alias("last_year"), F.array("o_orderpriority").alias("entries"))
    sk.append_manifest(rows.where("stage = 'climo'"), path)
    o.where("o_orderkey % 97 = 0").select(F.concat(F.lit('{"entry": "'), F.col("o_orderkey")).alias("value")).write.mode("append").text(path)
    sk.append_manifest(rows.where("stage <> 'climo'"), path)
    return sk.read_manifest(spark, path).groupBy("entry", "stage", "first_year").agg(F.count("*").alias("n"))


_AFTER = """, known AS (SELECT DISTINCT model, var FROM arc), slots AS (SELECT model, var, init_date, COUNT(value) AS filled FROM arc GROUP BY 1, 2, 3), mark AS (SELECT model, MAX(init_date) AS m FROM arc GROUP BY 1),
fresh AS (SELECT l.* FROM land l JOIN mark USING (model) WHERE init_date > m
  OR ((l.model, l.var) NOT IN (SELECT model, var FROM known) AND (l.model, l.init_date) IN (SELECT model, init_date FROM arc))
  OR ((l.model, l.var) IN (SELECT model, var FROM known) AND init_date BETWEEN m - 3 AND m AND (l.model, l.var, l.init_date) NOT IN (SELECT model, var, init_date FROM slots WHERE filled > 0)
    AND (l.model, l.var, l.init_date) IN (SELECT model, var, init_date FROM land WHERE value IS NOT NULL))),
held AS (SELECT model, var, init_date, value FROM arc WHERE (model, var, init_date) NOT IN (SELECT model, var, init_date FROM fresh) UNION ALL SELECT model, var, init_date, value FROM fresh)
SELECT model, var, init_date, COUNT(*) AS cells, COUNT(value) AS filled, SUM(value) AS total FROM held GROUP BY 1, 2, 3"""


def _counted(archive):
    return archive.groupBy("model", "var", "init_date").agg(F.count("*").alias("cells"), F.count("value").alias("filled"), F.sum("value").alias("total"))


@query(_ARC + _AFTER)
def archive_after_sync(spark, sf_dir):
    """M1-M6: the initial write, then new starts, a new variable and late data."""
    root = scratch(spark, "archive")
    land = store(_land(spark, sf_dir), "landing")
    ar.sync_archive(_archive(land), root)
    ar.sync_archive(land, root)
    return _counted(Archive(spark, root).read(land.schema))


@query(_ARC + """, good AS (SELECT model, var, init_date FROM land GROUP BY 1, 2, 3 HAVING COUNT(value) > 0)
SELECT model, var, init_date, COUNT(*) AS cells, COUNT(value) AS filled, SUM(value) AS total FROM land JOIN good USING (model, var, init_date) GROUP BY 1, 2, 3""")
def landing_catch_up(spark, sf_dir):
    """Two deliveries to a landing folder, picked up by two runs of the stream; empty files stay out."""
    landing, archive, state = (scratch(spark, x) for x in ("landing", "archive", "stream"))
    land = store(_land(spark, sf_dir), "landing")
    full = land.withColumns({"kind": F.lit("forecast"), "member": F.lit(1), "lead_days": (F.col("lead_ix") + 0.5).cast("float"), "valid_date": F.date_add("init_date", F.col("lead_ix")), "level": F.lit(None).cast("int")})
    full = full.select(*[x.split()[0] for x in cu.SCHEMA.split(", ")])
    newest = land.groupBy("model").agg(F.max("init_date").alias("_m"))
    late = F.col("init_date") > F.date_sub("_m", 2)
    dated = full.join(F.broadcast(newest), "model")
    for part in (dated.where(~late), dated.where(late)):
        part.select(*full.columns).coalesce(8).write.mode("append").parquet(landing)
        landing_stream(spark, landing, archive, state).awaitTermination()
    return _counted(Archive(spark, archive).read(full.schema))


@query(f"""WITH {CUBE}, f AS (SELECT model, var, init_date, member, lead_ix, COUNT(*) AS n FROM cube GROUP BY ALL), w AS (SELECT model, var, COUNT(*) AS fields FROM f GROUP BY ALL),
r AS (SELECT model, var, init_date, COUNT(*) AS fields FROM f WHERE NOT (model LIKE 'R-%' AND member = 7) GROUP BY ALL)
SELECT model, var, init_date, COUNT(*) AS cells, COUNT(value) AS filled, SUM(value) AS total FROM cube WHERE NOT (model LIKE 'R-%' AND member = 7) AND (model, var) IN (SELECT w.model, w.var FROM w JOIN r USING (model, var) WHERE w.fields = r.fields) GROUP BY 1, 2, 3""")
def split_deliveries(spark, sf_dir):
    """Every slot arrives in three deliveries of members; slots that still lack fields afterwards stay out."""
    landing, archive, state = (scratch(spark, x) for x in ("landing", "archive", "stream"))
    c = store(_full(cube(spark, sf_dir), "forecast"), "landed")
    expected = c.select("model", "var", "member", "lead_ix").distinct().groupBy("model", "var").agg(F.count("*").cast("int").alias("fields"))
    come = c.where(~(F.col("model").startswith("R-") & (F.col("member") == 7)))
    for members in ((1, 2, 5), (3, 5), (4, 6, 7)):
        come.where(F.col("member").isin(*members)).coalesce(4).write.mode("append").parquet(landing)
        landing_stream(spark, landing, archive, state, expected=expected).awaitTermination()
    return _counted(Archive(spark, archive).read(c.schema).dropDuplicates(["model", "var", "member", "lead_ix", "lat", "lon"]))


@query(_ARC + """, v1 AS (SELECT 1 AS version, * FROM arc), v2 AS (SELECT 2 AS version, l.* FROM land l WHERE model LIKE 'N%' AND init_date > (SELECT MAX(init_date) FROM arc WHERE arc.model = l.model) UNION ALL SELECT 2, * FROM arc)
SELECT CAST(version AS INT) AS version, model, var, COUNT(*) AS cells, COUNT(value) AS filled, SUM(value) AS total FROM (SELECT * FROM v1 UNION ALL SELECT * FROM v2) GROUP BY 1, 2, 3""")
def versions_of_two_writers(spark, sf_dir):
    """M6: of two writers that start from one version the first commits and the second fails; both versions stay readable."""
    root = scratch(spark, "archive")
    land = store(_land(spark, sf_dir), "landing")
    archive = Archive(spark, root)
    archive.commit(0, archive.stage(_archive(land))[1])
    newest = archive.slots(1).groupBy("model").agg(F.max("init_date").alias("_m"))
    late = land.join(newest, "model").where(F.col("init_date") > F.col("_m")).select(*land.columns)
    first, second = (archive.stage(late.where(w))[1] for w in ("model LIKE 'N%'", "model NOT LIKE 'N%'"))
    archive.commit(1, first)
    try:
        archive.commit(1, second)
        raise AssertionError("two writers committed one version")
    except Conflict:
        pass
    seen = [archive.read(land.schema, v).withColumn("version", F.lit(v)) for v in (1, 2)]
    return seen[0].unionByName(seen[1]).groupBy("version", "model", "var").agg(F.count("*").alias("cells"), F.count("value").alias("filled"), F.sum("value").alias("total"))


@query(f"""WITH {CUBE}, f AS (SELECT DISTINCT model, var, init_date FROM cube)
SELECT model, var, CASE WHEN model LIKE 'N%' THEN 'changed_since_audit' WHEN var = 'tas' THEN 'verify_failed_reverted' ELSE 'relabelled' END AS result,
CASE WHEN model NOT LIKE 'N%' AND var = 'pr' THEN 0.5::DOUBLE WHEN model LIKE 'N%' THEN 2::DOUBLE ELSE 1::DOUBLE END AS first_lead FROM f WHERE model <> 'A-F'
UNION ALL SELECT model, var, NULL, 1::DOUBLE FROM f WHERE model = 'A-F'""")
def relabelled_archive(spark, sf_dir):
    """M10 on a stored archive: one model isn't audited, one changed since the audit, one variable comes out damaged."""
    root, log = scratch(spark, "archive"), scratch(spark, "revert")
    c = _full(cube(spark, sf_dir), "forecast")
    shifted = c.withColumn("lead_days", (F.col("lead_ix") + F.when(F.col("model").startswith("N"), 2).otherwise(1)).cast("float"))
    archive = Archive(spark, root)
    archive.commit(0, archive.stage(store(shifted, "shifted"))[1])
    stored = archive.read(c.schema)
    whole = F.transform(F.sequence(F.lit(0), F.max("lead_ix")), lambda i: i.cast("float"))
    files = stored.where("model <> 'A-F'").groupBy(*ar.FILE).agg(whole.alias("_ix"), F.array_sort(F.collect_set("lead_days")).alias("_own"))
    audit = files.select(*ar.FILE, F.when(F.col("model").startswith("N"), F.transform("_own", lambda x: x - 1)).otherwise(F.col("_own")).alias("leads"), F.transform("_ix", lambda x: x + F.lit(0.5).cast("float")).alias("canon"), F.lit("relabel").alias("status"))

    def damaging(cells, due):
        out = ar.relabel_leads(cells, due)
        return out.withColumn("value", F.when((F.col("var") == "tas") & (F.col("lead_ix") == 3), F.col("value") + 1).otherwise(F.col("value")))

    result = ar.relabel_archive(spark, root, c.schema, store(audit, "audit"), log, relabel=damaging)
    first = archive.read(c.schema).groupBy("model", "var").agg(F.min(F.col("lead_days") - F.col("lead_ix")).cast("double").alias("first_lead"))
    return first.join(result.select("model", "var", "result"), ["model", "var"], "left").select("model", "var", "result", "first_lead")


@query("""WITH w AS (SELECT user_id, value, date_trunc('day', ts) - (CAST(range AS INT) || ' days')::INTERVAL AS s FROM events CROSS JOIN range(0, 7))
SELECT strftime(s, '%Y-%m-%d') AS window_start, user_id, COUNT(*) FILTER (value > 20) AS crossings, COUNT(*) AS n FROM w
WHERE s + INTERVAL 9 DAY <= (SELECT MAX(ts) FROM events) GROUP BY 1, 2 HAVING COUNT(*) FILTER (value > 20) >= 2""")
def crossing_stream_output(spark, sf_dir):
    """R2 as a stream: windows that end two days or more before the newest event are finished and stored."""
    source, out, state = (scratch(spark, x) for x in ("events", "crossings", "stream"))
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    events.write.parquet(source)
    crossing_stream(spark.readStream.schema(events.schema).parquet(source), out, state, 20, 2).awaitTermination()
    schema = "user_id {}, window_start timestamp, window_end timestamp, crossings long, n long".format(events.schema["user_id"].dataType.simpleString())
    return spark.read.schema(schema).parquet(out).select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "user_id", "crossings", "n")


@query(f"""WITH {CAT}, e AS (SELECT DISTINCT model, var FROM files), f AS (SELECT DISTINCT model, var FROM files WHERE init_date BETWEEN DATE '1998-06-14' AND DATE '1998-06-15')
SELECT e.model, CASE WHEN e.model IN ('G-M1', 'G-M3') THEN 'fail_on_missing' ELSE 'warn' END AS policy, COUNT(*) FILTER (f.var IS NULL) AS missing,
CAST(CASE WHEN e.model IN ('G-M1', 'G-M3') AND COUNT(*) FILTER (f.var IS NULL) > 0 THEN 1 ELSE 0 END AS INT) AS code FROM e LEFT JOIN f ON e.model = f.model AND e.var = f.var GROUP BY 1""")
def policy_codes(spark, sf_dir):
    """V2: what a missing file means for each model."""
    c = catalog(spark, sf_dir)
    report = va.presence(c.select("model", "var").distinct(), c, "1998-06-15", 2)
    policy = F.when(F.col("model").isin("G-M1", "G-M3"), "fail_on_missing").otherwise("warn")
    return va.policy_codes(report, c.select("model", policy.alias("policy")).distinct()).select("model", "policy", "missing", "code")


@query(f"""WITH {CUBE} SELECT 'lat' AS axis, lat AS label, CAST(ROW_NUMBER() OVER (ORDER BY lat) - 1 AS INT) AS ix FROM (SELECT DISTINCT lat FROM cube)
UNION ALL SELECT 'lon', lon, CAST(ROW_NUMBER() OVER (ORDER BY lon) - 1 AS INT) FROM (SELECT DISTINCT lon FROM cube)""")
def grid_ranks(spark, sf_dir):
    """Positions of the distinct labels of each axis."""
    c = cube(spark, sf_dir)
    parts = [gr.grid_rank(c, x).select(F.lit(x).alias("axis"), F.col(x).alias("label"), "ix") for x in ("lat", "lon")]
    return parts[0].unionByName(parts[1])


@query("""SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS entry, arg_min(o_custkey, o_orderkey)::DOUBLE AS first FROM orders GROUP BY 1, 2""")
def earliest_values(spark, sf_dir):
    """Of the values of one cell the earliest wins; a column for each of the five priorities."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("var"), F.col("o_custkey").cast("double").alias("value"), "o_orderkey")
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = no.widen_vars(o, names, order="o_orderkey")
    return wide.unpivot(["day"], names, "entry", "first").where("first IS NOT NULL")


@query(f"""WITH {CAT} SELECT name, day, CAST(batch AS INT) AS batch, CAST(batches AS INT) AS batches FROM (SELECT path AS name, init_date AS day, ceil(ROW_NUMBER() OVER (ORDER BY path) / 64.0) AS batch,
ceil((SELECT COUNT(*) FROM files) / 64.0) AS batches FROM files)""")
def worklist_batches(spark, sf_dir):
    """Batches of one worklist, numbered without a sort in one task."""
    c = ct.chunk(catalog(spark, sf_dir).select("path", "init_date"), 64)
    return c.select(F.col("path").alias("name"), F.col("init_date").alias("day"), "batch", "batches")
