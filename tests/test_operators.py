"""Closed-form cases of the operators, and numpy for the statistics."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteoloom.functions import calendar as ca
from meteoloom.operators import anomaly as an
from meteoloom.operators import archive as ar
from meteoloom.operators import climatology as cl
from meteoloom.operators import exceedance as ex
from meteoloom.operators import normalise as no
from meteoloom.operators import quality as qu
from meteoloom.operators import regions as rg
from meteoloom.operators import regrid as gr
from meteoloom.operators import thresholds as th
from meteoloom.operators import validation as va
from meteoloom.operators import weekly as wk
from meteoloom.sources import catalog as ct
from meteoloom.sources import cube as cu
from meteoloom.sources import sinks as sk
from meteoloom.sources import snapshots as sn
from meteoloom.streaming import landing as st

START = dt.date(2026, 3, 5)


def field(spark, values, members=4, leads=14):
    """values(member, lead) on one cell, over daily dates from 2026-03-05."""
    rows = [("A", "pr", m, i, START + dt.timedelta(i), 10.0, 100.0, values(m, i)) for m in range(1, members + 1) for i in range(leads)]
    return spark.createDataFrame(rows, "model string, var string, member int, lead_ix int, valid_date date, lat double, lon double, value double")


def limits(spark, value=1.0, leads=14):
    return spark.createDataFrame([("A", "pr", i, 10.0, 100.0, value) for i in range(leads)], "model string, var string, lead_ix int, lat double, lon double, threshold double")


def probs(df):
    return [r["probability"] for r in df.orderBy("lead_ix").collect()]


class TestExceedance:
    def test_always_never_half(self, spark):
        assert probs(ex.exceedance(field(spark, lambda m, i: 2.0), limits(spark))) == [100.0] * 8
        assert probs(ex.exceedance(field(spark, lambda m, i: 0.5), limits(spark))) == [0.0] * 8
        assert probs(ex.exceedance(field(spark, lambda m, i: 2.0 if m <= 2 else 0.0), limits(spark))) == [50.0] * 8

    def test_windows(self, spark):
        f = field(spark, lambda m, i: 2.0 if i == 6 else 0.0)
        assert probs(ex.exceedance(f, limits(spark), window=1)) == [0.0] * 6 + [100.0] + [0.0] * 7
        assert probs(ex.exceedance(f, limits(spark), window=3)) == [0.0] * 4 + [100.0] * 3 + [0.0] * 5
        assert ex.exceedance(field(spark, lambda m, i: 2.0, leads=3), limits(spark)).count() == 0

    def test_all_below_min_days(self, spark):
        f = field(spark, lambda m, i: 0.0 if i in (3, 4, 5) else 2.0)
        assert sum(probs(ex.exceedance(f, limits(spark), 3, "below", "all"))) == 100.0
        assert sum(probs(ex.exceedance(f, limits(spark), 3, "below", min_days=2))) == 300.0

    def test_equal_and_missing_never_cross(self, spark):
        assert sum(probs(ex.exceedance(field(spark, lambda m, i: 1.0), limits(spark)))) == 0
        gap = field(spark, lambda m, i: None if i == 7 else 2.0)
        assert probs(ex.exceedance(gap, limits(spark), 2, aggregate="all")) == [100.0] * 6 + [0.0] * 2 + [100.0] * 5
        absent = gap.where("lead_ix <> 7 OR member > 1")
        assert probs(ex.exceedance(absent, limits(spark), 2, aggregate="all")) == [100.0] * 6 + [0.0] * 2 + [100.0] * 5

    def test_a_model_without_values_raises(self, spark):
        f = field(spark, lambda m, i: 2.0)
        with pytest.raises(Exception, match="no value at any lead: B pr"):
            ex.exceedance(f.unionByName(f.withColumns({"model": F.lit("B"), "value": F.lit(None).cast("double")})), limits(spark)).collect()

    def test_bad_arguments(self, spark):
        f = field(spark, lambda m, i: 1.0)
        for bad in ({"direction": "up"}, {"aggregate": "some"}, {"window": 0}):
            with pytest.raises(ValueError):
                ex.exceedance(f, limits(spark), **bad)

    def test_pool_keeps_shared_windows(self, spark):
        d = [START + dt.timedelta(i) for i in range(3)]
        c = spark.createDataFrame([("pr", "A", d[0], 0.0, 0.0, 2), ("pr", "A", d[1], 0.0, 0.0, 1), ("pr", "B", d[1], 0.0, 0.0, 3)], "var string, model string, valid_date date, lat double, lon double, count long")
        n = spark.createDataFrame([("A", 4), ("B", 6)], "model string, nens long")
        assert [(r["valid_date"], r["probability"]) for r in ex.pool_models(c, n).collect()] == [(d[1], 40.0)]

    def test_report(self, spark):
        keys = "model string, var string"
        models = spark.createDataFrame([("A", "pr"), ("B", "pr"), ("C", "pr")], keys)
        cat = spark.createDataFrame([("A", "pr", "0305"), ("B", "pr", "0501")], keys + ", mmdd string")
        p = spark.createDataFrame([("A", "pr", 10.0), ("A", "pr", None)], keys + ", probability double")
        got = {r["model"]: (r["status"], r["mean"], r["finite"], r["total"]) for r in ex.exceedance_report(models, cat, p, "0303").collect()}
        assert got == {"A": ("ok", 10.0, 1, 2), "B": ("no_threshold_within_7_days", None, None, None), "C": ("missing_threshold", None, None, None)}


class TestThresholds:
    def test_nearest_label(self, spark):
        cat = spark.createDataFrame([("A", m) for m in ("0303", "0308", "0320", "0103")], "model string, mmdd string")
        pick = lambda w, n=7: [r["mmdd"] for r in th.nearest_mmdd(cat, w, n, ["model"]).collect()]
        assert pick("0303") == ["0303"] and pick("0305") == ["0303"] and pick("0306") == ["0308"]
        assert pick("1230") == ["0103"] and pick("0601") == [] and pick("0601", None) == ["0320"]
        bad = spark.createDataFrame([("A", "zz99"), ("A", "0101")], "model string, mmdd string")
        assert [r["mmdd"] for r in th.nearest_mmdd(bad, "0601", None, ["model"]).collect()] == ["0101"]

    def test_nearest_rank_counts_missing(self, spark):
        rng = np.random.default_rng(3)
        days = [dt.date(2000 + y, 1, 1) + dt.timedelta(int(d)) for y in range(6) for d in rng.choice(365, 60, replace=False)]
        values = [None if x < 0.2 else float(round(x, 3)) for x in rng.random(len(days))]
        h = spark.createDataFrame([("A", "pr", 0, 0.0, 0.0, d, v) for d, v in zip(days, values)], "model string, var string, lead_ix int, lat double, lon double, init_date date, value double")
        got = {r["doy"]: r["threshold"] for r in th.thresholds(h, 90).collect()}
        doy = np.array([dt.date(2000, d.month, d.day).timetuple().tm_yday for d in days])
        for target in range(1, 367):
            gap = np.abs(doy - target)
            pool = [v for v, near in zip(values, np.minimum(gap, 366 - gap) <= 15) if near]
            if not pool:
                assert target not in got
                continue
            k = int(np.round(0.9 * (len(pool) - 1)))
            assert got[target] == sorted(pool, key=lambda v: (v is None, v or 0))[k]

    def test_already_built(self, spark):
        e = spark.createDataFrame([("a", "climo", 2001, 2016), ("b", "climo", 2001, 2016)], "entry string, stage string, first_year int, last_year int")
        m = spark.createDataFrame([("climo", 2001, 2016, ["a"])], "stage string, first_year int, last_year int, entries array<string>")
        assert [r["entry"] for r in th.already_built(e, m).collect()] == ["a"]


class TestClimatology:
    def test_two_smoothing_passes(self, spark):
        rng = np.random.default_rng(1)
        x = np.where(rng.random(366) < 0.5, np.nan, rng.random(366))
        rows = [("A", "pr", 0, 0.0, 0.0, i + 1, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
        df = spark.createDataFrame(rows, "model string, var string, lead_ix int, lat double, lon double, doy int, value double")
        got = [r["value"] for r in cl.circular_smooth(df).orderBy("doy").collect()]
        for _ in range(2):
            x = np.array([np.nanmean(np.concatenate([x, x, x])[366 + i - 15 : 366 + i + 16]) for i in range(366)])
        assert np.allclose(got, x, atol=1e-12)

    def test_day_means_weigh_members_not_rows(self, spark):
        day = dt.date(2001, 3, 1)
        rows = [("A", "pr", 0, 0.0, 0.0, day, 1, 1.0), ("A", "pr", 0, 0.0, 0.0, day, 1, 3.0), ("A", "pr", 0, 0.0, 0.0, day, 2, 8.0)]
        df = spark.createDataFrame(rows, "model string, var string, lead_ix int, lat double, lon double, init_date date, member int, value double")
        got = cl.climatology(df, 2001, 2001, passes=0).where("value IS NOT NULL").collect()
        assert [(r["doy"], r["mmdd"], r["value"]) for r in got] == [(60, "0229", 5.0)]


class TestWeekly:
    def test_reduce(self, spark):
        rows = [(v, dt.date(2026, 3, 7) + dt.timedelta(i), 1.0) for v in ("pr", "tas") for i in range(28)]
        df = spark.createDataFrame(rows, "var string, valid_date date, value double")
        got = {(r["var"], r["week"]): r["value"] for r in wk.weekly_reduce(df, "2026-03-05").collect()}
        assert got == {("pr", w): 7 * 86400.0 for w in (1, 2, 3, 4)} | {("tas", w): 1.0 for w in (1, 2, 3, 4)}

    def test_uncovered_week_is_zero_or_missing(self, spark):
        df = spark.createDataFrame([("pr", dt.date(2026, 3, 7), 1.0), ("tas", dt.date(2026, 3, 7), 1.0)], "var string, valid_date date, value double")
        zero = {(r["var"], r["week"]): r["value"] for r in wk.weekly_reduce(df, "2026-03-05").collect()}
        null = {(r["var"], r["week"]): r["value"] for r in wk.weekly_reduce(df, "2026-03-05", empty_sum="null").collect()}
        assert zero["pr", 2] == 0 and zero["tas", 2] is None and null["pr", 2] is None

    def test_mean_needs_two_models(self, spark):
        one = spark.createDataFrame([("A", 1.0)], "model string, value double")
        assert wk.multi_model_mean(one).count() == 1
        two = spark.createDataFrame([("A", 1.0), ("B", 3.0)], "model string, value double")
        assert {r["model"]: r["value"] for r in wk.multi_model_mean(two).collect()}["SUBC-MME"] == 2.0


class TestNormalise:
    def test_longitudes(self, spark):
        df = spark.createDataFrame([(-10.0,), (20.0,), (190.0,)], "lon double")
        assert [r[0] for r in no.ensure_lon(df).collect()] == [350.0, 20.0, 190.0]
        assert [r[0] for r in no.ensure_lon(df, "negpos").collect()] == [-10.0, 20.0, -170.0]
        with pytest.raises(ValueError):
            no.ensure_lon(df, "odd")

    def test_missing_and_names(self, spark):
        df = cu.missing_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "value double"))
        assert [r[0] for r in df.collect()] == [None, 1.0]
        assert no.canonical_columns(spark.createDataFrame([(1, 2, 3)], "Y int, longitude int, x2 int")).columns == ["lat", "lon", "x2"]
        n = spark.createDataFrame([("EMC-GEFSv12 (x)", 200)], "m string, l int").select(no.safe_tag(F.col("m")), no.output_name(F.lit("ua"), F.col("l")), no.product_tag(F.lit(95), F.lit("above")), no.legacy_model(F.col("m")))
        assert tuple(n.first()) == ("EMC-GEFSv12_x_", "ua_200", "p95_above", "GEFSv12 (x)")

    def test_lead_labels(self, spark):
        rows = [(p, i) for p, n in (("ECCC", 39), ("GEFS", 34), ("GMAO_V3", 75)) for i in range(n)]
        df = no.label_leads(spark.createDataFrame(rows, "provider string, lead_ix int"))
        got = {r["provider"]: (r["a"], r["b"], r["n"]) for r in df.groupBy("provider").agg(F.min("lead_days").alias("a"), F.max("lead_days").alias("b"), F.count("*").alias("n")).collect()}
        assert got == {"ECCC": (0.5, 38.5, 39), "GEFS": (1.5, 34.5, 34), "GMAO_V3": (0.5, 74.5, 75)}
        assert no.cap_lead(df.where("provider = 'GMAO_V3'")).count() == 45
        assert no.cap_lead(spark.range(60).select(F.col("id").cast("float").alias("lead_days"))).count() == 46

    def test_lead_from_valid_and_level(self, spark):
        df = spark.createDataFrame([(dt.datetime(2026, 3, 5), dt.datetime(2026, 3, 6, 12))], "init_ts timestamp_ntz, valid_ts timestamp_ntz")
        assert no.lead_from_valid(df).first()["lead_days"] == 1.5
        lv = spark.createDataFrame([("A", "ua", 200), ("A", "ua", 850), ("A", "pr", None)], "model string, var string, level int")
        dims = spark.createDataFrame([("A", "ua", 200), ("A", "pr", None)], "model string, var string, level int")
        assert no.select_level(lv, dims).count() == 2

    def test_start_spine_and_drift(self, spark):
        rows = [("C", "pr", START, dt.datetime(2026, 3, 5, h), 1, 1.0) for h in (0, 12)]
        df = spark.createDataFrame(rows, "model string, var string, init_date date, init_ts timestamp_ntz, member int, value double")
        got = no.start_spine(df).orderBy("init_ts").collect()
        assert [r["init_ts"].hour for r in got] == [0, 6, 12, 18] and [r["value"] for r in got] == [1.0, None, 1.0, None]
        a = spark.createDataFrame([("A", "pr", 0, 1.0), ("A", "pr", 1, 2.0)], "model string, var string, lead_ix int, lead_days double")
        ref = spark.createDataFrame([(0, 0.5), (1, 2.0)], "lead_ix int, lead_days double")
        assert no.lead_drift(a, ref).count() == 1
        assert [r["lead_days"] for r in no.align_leads(a, ref).orderBy("lead_ix").collect()] == [0.5, 2.0]

    def test_pad_levels(self, spark):
        df = spark.createDataFrame([("A", "ua", 200, 1.0), ("A", "va", 850, 2.0)], "model string, var string, level int, value double")
        assert no.pad_union(df, "level", over=("model",)).count() == 4


class TestRegions:
    def test_domain_with_descending_axis(self, spark):
        rows = [(float(y), float(x)) for y in (75, 60, 45, 30, 15, 0) for x in (210, 220, 230, 270, 280)]
        df = rg.domain_view(spark.createDataFrame(rows, "lat double, lon double"), (-140, -90), (15, 75))
        assert df.count() == 15 and df.agg(F.min("lon"), F.max("lon")).first() == (-140.0, -90.0)

    def test_empty_region(self, spark):
        df = spark.createDataFrame([(0.0, 10.0)], "lat double, lon double")
        boxes = spark.createDataFrame([("a", 0.0, 20.0, -5.0, 5.0), ("b", 50.0, 60.0, -5.0, 5.0)], "region string, west double, east double, south double, north double")
        assert [r["region"] for r in rg.empty_regions(df, boxes).collect()] == ["b"]

    def test_subsample_checks_the_grid(self, spark):
        df = spark.createDataFrame([(y / 2, x / 2) for y in range(-4, 5) for x in range(-4, 5)], "lat double, lon double")
        assert gr.subsample_grid(df, expected=(5, 5)).count() == 25
        with pytest.raises(ValueError):
            gr.subsample_grid(df, expected=(5, 4))


class TestCatalog:
    def test_newest(self, spark):
        names = [f"/d/forecast/pr/pr_EMC-GEFSv12_CPC_{d}.daily.nc" for d in ("20260510", "20260514", "20260501", "20260515", "2026051x")]
        c = ct.parse_catalog(spark.createDataFrame([(n,) for n in names], "path string"))
        assert [str(r["init_date"]) for r in ct.newest_init(c, "2026-05-15").collect()] == ["2026-05-14"]
        assert [str(r["init_date"]) for r in ct.newest_in_lookback(c, "2026-05-15", 1).collect()] == ["2026-05-15"]
        bad = spark.createDataFrame([("/d/forecast/pr/pr_A-B_20261340.daily.nc",)], "path string")
        assert ct.parse_catalog(bad).first()["init_date"] is None

    def test_date_tokens(self, spark):
        df = spark.createDataFrame([("x_20260305.nc",), ("a05mar2026b",), ("20261399_20260306",), ("none",)], "n string")
        assert [str(r[0]) for r in df.select(ca.parse_date_token(F.col("n"))).collect()] == ["2026-03-05", "2026-03-05", "2026-03-06", "None"]

    def test_resend(self, spark):
        p = lambda m, v, d=20260101: f"/r/forecast/{v}/{v}_G-{m}_{d}.daily.nc"
        paths = [p("A", "pr"), p("A", "pr"), p("A", "zz"), p("B", "pr"), p("A", "pr") + ".tmp1", "/else/x.nc", p("A", "pr", 20260102)]
        man = spark.createDataFrame([(x,) for x in paths], "path string")
        allowed = spark.createDataFrame([("G-A", "pr")], "model string, var string")
        jobs = ct.resend_jobs(man, "/r", allowed, spark.createDataFrame([(paths[0],)], "path string"))
        assert {r["status"]: r["n"] for r in va.status_counts(jobs).collect()} == {"send": 1, "not_mirrored": 2, "tmp": 1, "outside_root": 1, "missing_locally": 1}

    def test_files(self, spark, tmp_path):
        (tmp_path / "a").mkdir()
        (tmp_path / "a" / "x.nc").write_bytes(b"123")
        assert [r["bytes"] for r in ct.list_files(spark, str(tmp_path)).collect()] == [3]


class TestValidation:
    def test_presence_and_policy(self, spark):
        e = spark.createDataFrame([("G-A", "pr"), ("G-A", "tas")], "model string, var string")
        c = ct.parse_catalog(spark.createDataFrame([("/d/forecast/pr/pr_G-A_20260305.daily.nc",)], "path string"))
        r = va.presence(e, c, "2026-03-05", 2)
        assert {x["var"]: x["ok"] for x in r.collect()} == {"pr": True, "tas": False}
        assert va.enforce(r, "fail_on_missing") == 1 and va.enforce(r, "warn") == 0

    def test_schemas(self, spark):
        rows = [("a", "M", 21), ("a", "L", 39), ("a", "Y", 181), ("a", "X", 360), ("b", "time", 39), ("b", "latitude", 181), ("b", "longitude", 360), ("c", "time", 39), ("c", "lat", 90), ("c", "lon", 360)]
        d = va.dims_map(spark.createDataFrame(rows, "path string, dim string, size int"))
        side = lambda p, names: d.where(F.col("path") == p).select(F.lit("A").alias("model"), F.lit("pr").alias("var"), "dims", F.array(*map(F.lit, names)).alias("names"))
        assert va.schema_parity(side("a", ["pr"]), side("b", ["PR_sfc"])).first()["compatible"]
        assert not va.schema_parity(side("a", ["pr"]), side("c", ["pr"])).first()["compatible"]
        assert not va.schema_parity(side("a", ["pr"]), side("b", ["tas"])).first()["compatible"]

    def test_smoke(self, spark):
        none = spark.range(0)
        assert va.smoke_manifest(none, "2026-03-05", True).first()["smoke_mode"]
        with pytest.raises(ValueError):
            va.smoke_manifest(none, "2026-03-05", False)


def landing(spark, days, variables=("pr", "tas"), value=1.0):
    rows = [("forecast", "A", v, START + dt.timedelta(d), dt.datetime(2026, 3, 5) + dt.timedelta(d), 1, i, 0.5 + i, START + dt.timedelta(d + i), None, 0.0, 0.0, value) for v in variables for d in days for i in range(3)]
    return spark.createDataFrame(rows, cu.SCHEMA)


def prints(df):
    return sorted(map(tuple, ar.fingerprint(df).collect()))


class TestArchive:
    def test_sync(self, spark, tmp_path):
        root = str(tmp_path / "arc")
        assert {r["action"] for r in ar.sync_archive(landing(spark, range(3)), root).collect()} == {"append"}
        read = lambda: sn.Archive(spark, root).read(cu.SCHEMA)
        before = prints(read())
        dry = ar.sync_archive(landing(spark, range(5)), root, dry_run=True).collect()
        assert len(dry) == 4 and prints(read()) == before
        assert ar.sync_archive(landing(spark, range(3)), root).count() == 0
        ar.sync_archive(landing(spark, range(3, 4), value=None).unionByName(landing(spark, range(3), ("ua",))), root)
        assert read().select("var").distinct().count() == 3
        assert {r["action"] for r in ar.sync_archive(landing(spark, range(5)), root).collect()} == {"append", "backfill"}
        got = read().groupBy("var").agg(F.count("value").alias("n")).collect()
        assert {r["var"]: r["n"] for r in got} == {"pr": 15, "tas": 15, "ua": 9}

    def test_of_two_writers_one_succeeds(self, spark, tmp_path, monkeypatch):
        root = str(tmp_path / "arc")
        ar.sync_archive(landing(spark, range(2)), root)
        stage = sn.Archive.stage

        def other_first(self, rows):
            monkeypatch.setattr(sn.Archive, "stage", stage)
            ar.sync_archive(landing(spark, range(2, 3)), root)  # another writer, between plan and commit
            return stage(self, rows)

        monkeypatch.setattr(sn.Archive, "stage", other_first)
        with pytest.raises(sn.Conflict):
            ar.sync_archive(landing(spark, range(4)), root)
        a = sn.Archive(spark, root)
        assert a.version() == 2 and a.read(cu.SCHEMA).count() == 18
        assert {str(r["init_date"]) for r in ar.sync_archive(landing(spark, range(4)), root).collect()} == {"2026-03-08"}
        assert a.read(cu.SCHEMA).count() == 24 and a.read(cu.SCHEMA, 1).count() == 12

    @pytest.mark.parametrize("step", ["stage", "commit", "_publish"])
    def test_a_broken_write_leaves_the_version(self, spark, tmp_path, monkeypatch, step):
        root = str(tmp_path / "arc")
        a = sn.Archive(spark, root)
        ar.sync_archive(landing(spark, range(3), value=None).unionByName(landing(spark, range(1), ("ua",))), root)
        before = prints(a.read(cu.SCHEMA))
        own = getattr(sn.Archive, step)

        def broken(self, *args):
            if step == "stage":
                own(self, *args)  # all files are there, then the job dies
            raise KeyboardInterrupt

        monkeypatch.setattr(sn.Archive, step, broken)
        with pytest.raises(KeyboardInterrupt):
            ar.sync_archive(landing(spark, range(4)), root)
        monkeypatch.setattr(sn.Archive, step, own)
        assert a.version() == 1 and prints(a.read(cu.SCHEMA)) == before
        ar.sync_archive(landing(spark, range(4)), root)
        got = a.read(cu.SCHEMA)
        assert a.version() == 2 and got.where("value is not null and var <> 'ua'").count() == 24 and got.count() == 27
        assert prints(a.read(cu.SCHEMA, 1)) == before
        a.roll_back(1)
        assert a.version() == 3 and prints(a.read(cu.SCHEMA)) == before
        a.roll_back(2)
        assert a.vacuum(1) > 0 and a.read(cu.SCHEMA).count() == 27

    def test_verification_stops_a_wrong_write(self, spark, tmp_path, monkeypatch):
        root = str(tmp_path / "arc")
        ar.sync_archive(landing(spark, range(1)), root)
        stage = sn.Archive.stage
        monkeypatch.setattr(sn.Archive, "stage", lambda self, rows: stage(self, rows.where("lead_ix <> 1")))
        with pytest.raises(RuntimeError):
            ar.sync_archive(landing(spark, range(2)), root)
        assert sn.Archive(spark, root).version() == 1

    def test_sub_daily_slots_share_a_partition(self, spark, tmp_path):
        root, a = str(tmp_path / "arc"), sn.Archive(spark, str(tmp_path / "arc"))
        noon = landing(spark, range(1)).withColumn("init_ts", F.expr("init_ts + interval 12 hours"))
        ar.sync_archive(landing(spark, range(1)).unionByName(noon.withColumn("value", F.lit(None).cast("double"))), root)
        plan = ar.sync_archive(landing(spark, range(1)).unionByName(noon), root).collect()
        assert {(r["action"], r["init_ts"].hour) for r in plan} == {("backfill", 12)}
        assert a.read(cu.SCHEMA).count() == 12 and a.read(cu.SCHEMA).where("value is null").count() == 0
        for d in range(1, 4):
            ar.sync_archive(landing(spark, range(d + 1)), root)
        assert a.read(cu.SCHEMA, where=F.col("init_date") > START).count() == 18
        ar.sync_archive(landing(spark, range(1)).withColumn("member", F.lit(5)), root)
        before = prints(a.read(cu.SCHEMA))
        assert a.compact(cu.SCHEMA, 1) == a.version() and prints(a.read(cu.SCHEMA)) == before
        assert a.files().count() == a.files().select("var", "init_date").distinct().count()

    def test_repair_guards(self, spark):
        a = landing(spark, range(4)).where("var = 'pr' OR init_date < DATE '2026-03-08'")
        assert ar.repair_gaps(a, landing(spark, range(4))).count() == 3
        with pytest.raises(RuntimeError):
            ar.repair_gaps(landing(spark, range(4)).where("var = 'pr' OR init_date < DATE '2026-03-07'"), landing(spark, range(4)))

    def test_relabel_compare_and_set_and_revert(self, spark):
        c = landing(spark, range(1), ("pr",)).withColumn("lead_days", (F.col("lead_ix") + 1).cast("float"))
        canon = ar.canonical_leads(spark.createDataFrame([("A", 0.5, 3)], "model string, first double, n int"))
        audit = ar.audit_leads(ar.lead_files(c), canon)
        assert audit.first()["status"] == "relabel"
        new = ar.relabel_leads(c, audit)
        labels = lambda d: sorted(r["lead_days"] for r in d.collect())
        assert labels(new) == [0.5, 1.5, 2.5]
        assert labels(ar.relabel_leads(new, ar.revert_log(audit))) == [1.0, 2.0, 3.0]
        changed = c.withColumn("lead_days", (F.col("lead_ix") + 2).cast("float"))
        assert labels(ar.relabel_leads(changed, audit)) == [2.0, 3.0, 4.0]
        st_ = lambda files: ar.audit_leads(files, canon).first()["status"]
        assert st_(ar.lead_files(c, "int64")) == "dtype_mismatch" and st_(ar.lead_files(c.where("lead_ix < 2"))) == "length_mismatch"
        assert st_(ar.lead_files(new)) == "ok" and st_(ar.lead_files(c).withColumn("leads", F.lit(None).cast("array<float>"))) == "unreadable"

    def test_relabelling_a_stored_archive(self, spark, tmp_path, monkeypatch):
        root, log = str(tmp_path / "arc"), str(tmp_path / "log")
        c = landing(spark, range(2)).withColumn("lead_days", (F.col("lead_ix") + 1).cast("float"))
        ar.sync_archive(c, root)
        a = sn.Archive(spark, root)
        canon = ar.canonical_leads(spark.createDataFrame([("A", 0.5, 3)], "model string, first double, n int"))
        audit = ar.audit_leads(ar.lead_files(a.read(cu.SCHEMA)), canon)
        run = lambda audit, **more: {r["result"] for r in ar.relabel_archive(spark, root, cu.SCHEMA, audit, log, **more).collect()}
        labels = lambda v=None: sorted({r["lead_days"] for r in a.read(cu.SCHEMA, v).collect()})
        before = prints(a.read(cu.SCHEMA))
        assert run(audit, apply=False) == {"would_relabel"} and a.version() == 1
        assert run(audit, relabel=lambda cells, due: ar.relabel_leads(cells, due).withColumn("value", F.lit(3.0))) == {"verify_failed_reverted"}
        assert labels() == [1.0, 2.0, 3.0] and prints(a.read(cu.SCHEMA)) == before
        assert run(audit) == {"relabelled"} and labels() == [0.5, 1.5, 2.5] and labels(1) == [1.0, 2.0, 3.0] and prints(a.read(cu.SCHEMA)) == before
        assert run(audit) == {"changed_since_audit"}
        undo = spark.read.parquet(log).distinct()
        assert run(undo) == {"relabelled"} and labels() == [1.0, 2.0, 3.0]

        def other_first(cells, due):
            ar.sync_archive(landing(spark, range(2, 3)), root)
            return ar.relabel_leads(cells, due)

        with pytest.raises(sn.Conflict):
            run(audit, relabel=other_first)
        assert a.read(cu.SCHEMA).count() == 18

    def test_shift_is_idempotent_and_reversible(self, spark):
        c = landing(spark, range(1), ("pr",)).withColumn("lead_days", F.col("lead_ix").cast("float"))
        once = ar.shift_leads(c)
        pick = lambda d: sorted(r["lead_days"] for r in d.collect())
        assert pick(once) == pick(ar.shift_leads(once)) == [0.5, 1.5, 2.5] and pick(ar.shift_leads(once, reverse=True)) == [0.0, 1.0, 2.0]
        assert ar.unexpected_leads(c.withColumn("lead_days", F.lit(9.0).cast("float"))).count() == 1
        assert ar.fingerprint(c).collect() == ar.fingerprint(once).collect()


class TestSinks:
    def test_cube_round_trip(self, spark, tmp_path):
        df = landing(spark, range(2)).unionByName(landing(spark, range(2, 3), value=float("nan")))
        cu.write_cube(df, str(tmp_path / "c"))
        assert cu.read_cube(spark, str(tmp_path / "c"), "forecast", ["A"], ["pr"]).where("value IS NULL").count() == 3
        cu.write_cube(df.withColumn("kind", F.lit("hindcast")), str(tmp_path / "c"))
        h = cu.read_hindcast(spark, str(tmp_path / "c"), 2026, 2026)
        assert h.select("init_date").distinct().count() == 2
        assert cu.add_ensemble_means(h.where("var = 'pr'"), h.where("var = 'tas'").drop("member", "lead_ix")).count() == 12

    def test_manifest_skips_bad_lines(self, spark, tmp_path):
        path = str(tmp_path / "m")
        sk.append_manifest(spark.createDataFrame([("a", "climo", 2001, 2016)], "entry string, stage string, first_year int, last_year int"), path)
        (tmp_path / "m" / "part-bad.json").write_text('{"entry": "b"}\n{broken\n')
        assert sorted(r["entry"] for r in sk.read_manifest(spark, path).collect()) == ["a", "b"]

    def test_products(self, spark, tmp_path):
        w = spark.createDataFrame([("A", "pr", 1, 0.0, 0.0, 1.0), ("A", "pr", 3, 0.0, 0.0, 2.0)], "model string, var string, week int, lat double, lon double, value double")
        sk.write_product(w, str(tmp_path / "p"), "2026-03-05")
        assert spark.read.parquet(str(tmp_path / "p")).where("fcst_date = DATE '2026-03-05'").count() == 2
        box = spark.createDataFrame([("a", -5.0, 5.0, -5.0, 5.0)], "region string, west double, east double, south double, north double")
        sk.write_region_weekly(rg.region_weekly(w, box), str(tmp_path / "r"))
        assert spark.read.parquet(str(tmp_path / "r")).where("week = 34").first()["units"] == "mm/2-weeks"
        assert sk.product_attributes(w, w).first()["mean_variables"] == ["pr"]
        t = spark.createDataFrame([("A", "pr", 95, "0101"), ("A", "pr", 95, "0102")], "model string, var string, pct int, mmdd string")
        sk.write_thresholds(th.split_thresholds(t, t.where("mmdd = '0101'")), str(tmp_path / "t"))
        assert spark.read.parquet(str(tmp_path / "t")).count() == 1


class TestQuality:
    def test_samples_and_median(self, spark):
        df = landing(spark, range(2)).withColumn("value", F.when(F.dayofmonth("init_date") == 5, F.lit(250.0)))
        keys = ["model", "var", "level", "init_date"]
        assert qu.drop_empty(df, keys).count() == 6
        # Every grid has its own middle: files far from the equator stay, and one of missing cells goes.
        for sample in ("centre", "strided", "plane"):
            assert qu.drop_empty(df, keys, sample).count() == 6
        with pytest.raises(ValueError):
            qu.drop_empty(df, keys, "other")
        assert qu.plausible_median(df, low=300).select("var").distinct().count() == 1

    def test_samples_by_position(self, spark):
        grid = [(y, x, m, i) for y in range(9) for x in range(30) for m in (1, 2) for i in (0, 1)]
        at = {"middle": lambda y, x: (y, x) == (6, 13), "corner": lambda y, x: (y, x) == (0, 0), "strides": lambda y, x: (y, x) == (8, 27), "none": lambda y, x: False}
        rows = [(f, m, i, 40.0 - 0.5 * y, 200.0 + 0.25 * x, 1.0 if has(y, x) and m == 1 and i == 0 else None) for f, has in at.items() for y, x, m, i in grid]
        rows += [("later", m, i, 40.0 - 0.5 * y, 200.0 + 0.25 * x, 1.0 if m == 2 else None) for y, x, m, i in grid]
        df = spark.createDataFrame(rows, "model string, member int, lead_ix int, lat double, lon double, value double")
        left = lambda s: {r["model"] for r in qu.drop_empty(df, ["model"], s).select("model").distinct().collect()}
        # Ascending latitudes: row 6 is the third of nine; rows 2 to 6 and columns 13 to 17 are the middle.
        assert left("centre") == {"middle"} and left("strided") == {"corner", "strides"} and left("plane") == {"middle", "corner", "strides"}
        assert left(None) == {"middle", "corner", "strides", "later"}
        seen = qu.sampled_cells(df, ["model"], "centre").where("model = 'none'")
        assert sorted({r["lat"] for r in seen.collect()}) == [37.0, 37.5, 38.0, 38.5, 39.0] and seen.count() == 25

    def test_first_climatology(self, spark):
        c = spark.createDataFrame([("B", 1), ("C", 2)], "model string, x int")
        names = spark.createDataFrame([("M", "A", 0), ("M", "B", 1), ("M", "C", 2)], "model string, name string, cand_ix int")
        assert [(r["model"], r["x"]) for r in an.first_available(c, names).collect()] == [("M", 1)]


class TestStreams:
    def test_landing(self, spark, tmp_path):
        land, arc, chk = (str(tmp_path / x) for x in ("land", "arc", "chk"))
        landing(spark, range(2)).coalesce(1).write.parquet(land)
        st.landing_stream(spark, land, arc, chk).awaitTermination()
        landing(spark, range(2, 3)).unionByName(landing(spark, range(3, 4), value=None)).coalesce(1).write.mode("append").parquet(land)
        st.landing_stream(spark, land, arc, chk).awaitTermination()
        got = sn.Archive(spark, arc).read(cu.SCHEMA)
        assert got.select("init_date").distinct().count() == 3 and got.count() == 18

    def test_a_slot_in_two_deliveries_is_whole(self, spark, tmp_path):
        """Without expectations: the second delivery extends the slot; a replay and a repeat change nothing."""
        land, arc, chk = (str(tmp_path / x) for x in ("land", "arc", "chk"))
        second = landing(spark, range(2)).withColumn("member", F.lit(2))
        for part in (landing(spark, range(2)), second, second, landing(spark, range(2)).withColumn("lead_ix", F.col("lead_ix") + 3)):
            part.coalesce(1).write.mode("append").parquet(land)
            st.landing_stream(spark, land, arc, chk).awaitTermination()
        got = sn.Archive(spark, arc).read(cu.SCHEMA)
        assert got.count() == 36 and got.select("var", "init_date", "member", "lead_ix").distinct().count() == 36
        assert sn.Archive(spark, arc).version() == 3
        st.landing_stream(spark, land, arc, str(tmp_path / "again")).awaitTermination()  # all deliveries once more
        assert sn.Archive(spark, arc).version() == 3

    def test_slots_wait_until_they_are_whole(self, spark, tmp_path):
        land, arc, chk = (str(tmp_path / x) for x in ("land", "arc", "chk"))
        expected = spark.createDataFrame([("A", "pr", 6), ("A", "tas", 9)], "model string, var string, fields int")
        held = lambda: {(r["var"], r["n"]) for r in sn.Archive(spark, arc).read(cu.SCHEMA).groupBy("var").agg(F.count("*").alias("n")).collect()}
        run = lambda wait=10**9: st.landing_stream(spark, land, arc, chk, expected=expected, wait_ms=wait).awaitTermination()
        part = lambda m, v=("pr", "tas"): landing(spark, range(1), v).withColumn("member", F.lit(m)).coalesce(1).write.mode("append").parquet(land)
        part(1)
        run(1000)
        assert sn.Archive(spark, arc).version() == 0
        part(1)
        part(2, ("pr",))  # one member again, and the last one of pr
        run()
        assert ("pr", 9) in held()  # the repeated member's rows are those of its field
        part(2, ("tas",))
        run()  # the wait for tas, from its first field, is over
        assert dict(held())["tas"] >= 6
        part(3, ("tas",))
        run()
        assert sn.Archive(spark, arc).read(cu.SCHEMA).where("var = 'tas'").select("member", "lead_ix").distinct().count() == 9

    def test_crossings(self, spark, tmp_path, sf_dir):
        src = f"{sf_dir}/events.parquet"
        schema = spark.read.parquet(src).schema
        (tmp_path / "in").mkdir()
        spark.read.parquet(src).write.mode("overwrite").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        st.crossing_stream(stream, str(tmp_path / "out"), str(tmp_path / "chk"), 20.0).awaitTermination()
        got = spark.read.schema("user_id long, window_start timestamp, window_end timestamp, crossings long, n long").parquet(str(tmp_path / "out"))
        want = st.crossing_counts(spark.read.parquet(src), 20.0).where("crossings >= 1")
        done = got.agg(F.max("window_end")).first()[0]
        assert got.count() == want.where(F.col("w.end") <= F.lit(done)).count() > 0
