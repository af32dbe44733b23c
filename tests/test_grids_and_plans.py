"""Grids off the origin, positions of padded models, ranks, and how often plans shuffle."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteoloom.functions.ranking import global_rank
from meteoloom.functions.selection import exact_quantiles, sliding_ranks
from meteoloom.operators import archive as ar
from meteoloom.operators import climatology as cl
from meteoloom.operators import exceedance as ex
from meteoloom.operators import normalise as no
from meteoloom.operators import regrid as gr
from meteoloom.operators import thresholds as th
from meteoloom.operators import validation as va
from meteoloom.sources import catalog as ct
from meteoloom.sources import cube as cu
from meteoloom.sources.snapshots import Archive
from meteoloom.sources.working import shared_dir

GRID = "model string, lat double, lon double, value double"
START = dt.date(2026, 3, 5)


def plane(spark, lats, lons, f=lambda y, x: 10 * y + x, model="A"):
    return spark.createDataFrame([(model, float(y), float(x), float(f(y, x))) for y in lats for x in lons], GRID)


def targets(spark, *cells):
    return spark.createDataFrame([tuple(map(float, c)) for c in cells], "lat double, lon double")


def values(df):
    return {(r["lat"], r["lon"]): None if r["value"] is None else round(r["value"], 9) for r in df.collect()}


class TestGrids:
    @pytest.mark.parametrize("first", [0.0, 0.5, -0.25, 37.3])
    @pytest.mark.parametrize("down", [False, True])
    def test_bilinear_is_exact_on_planes(self, spark, first, down):
        lats = [first + i for i in range(5)][:: -1 if down else 1]
        lons = [first / 3 + 2.5 * i for i in range(4)]
        inside = [(first + 0.3, lons[0] + 1.1), (first + 2, lons[1]), (first + 4, lons[3]), (first + 1.75, lons[2] + 2)]
        got = values(gr.bilinear(plane(spark, lats, lons), targets(spark, *inside)))
        assert all(abs(got[c] - (10 * c[0] + c[1])) < 1e-6 for c in inside)
        assert set(values(gr.bilinear(plane(spark, lats, lons), targets(spark, (first - 0.1, lons[0]), (first, lons[3] + 0.1)))).values()) == {None}

    def test_bilinear_on_half_cells(self, spark):
        """Centres 0.5, 1.5, ...: the source's own cells, and the middle of four."""
        centres = [0.5, 1.5, 2.5, 3.5]
        got = values(gr.bilinear(plane(spark, centres, centres), targets(spark, (1, 1), (2, 2), (0.5, 3.5)), 1, 1))
        assert got == {(1.0, 1.0): 11.0, (2.0, 2.0): 22.0, (0.5, 3.5): 8.5}

    def test_bilinear_misses_and_irregular_axes(self, spark):
        src = plane(spark, [0, 1, 2], [0, 1, 2]).where("NOT (lat = 1 AND lon = 1)")
        assert values(gr.bilinear(src, targets(spark, (0.5, 0.5), (0, 0.5)))) == {(0.5, 0.5): None, (0.0, 0.5): 0.5}

    def test_nearest_is_by_label_and_unbounded(self, spark):
        two = plane(spark, [10, 0], [0, 1, 2]).unionByName(plane(spark, [0.25, 5.25], [7], model="B"))
        got = gr.nearest_cell(two, targets(spark, (4.9, 0.4), (5, 0.5), (-70, 300)), grids=["model"]).collect()
        assert {(r["model"], r["lat"], r["lon"]): r["value"] for r in got} == {
            ("A", 4.9, 0.4): 0.0, ("A", 5.0, 0.5): 101.0, ("A", -70.0, 300.0): 2.0, ("B", 4.9, 0.4): 59.5, ("B", 5.0, 0.5): 59.5, ("B", -70.0, 300.0): 9.5,
        }


class TestPositions:
    def test_padded_models_meet_their_thresholds_from_the_first_lead(self, spark):
        """Three empty leads first; only the first threshold day is passed by the forecast."""
        rows = [("A", "pr", m, i, START + dt.timedelta(i), 10.0, 100.0, None if i < 3 or i > 12 else 2.0) for m in (1, 2) for i in range(14)]
        f = spark.createDataFrame(rows, "model string, var string, member int, lead_ix int, valid_date date, lat double, lon double, value double")
        t = spark.createDataFrame([("A", "pr", i, 10.0, 100.0, 1.0 if i == 0 else 5.0) for i in range(14)], "model string, var string, lead_ix int, lat double, lon double, threshold double")
        got = ex.exceedance(f, t, window=7).orderBy("lead_ix").collect()
        assert [(r["lead_ix"], r["valid_date"], r["count"]) for r in got] == [(6 + k, START + dt.timedelta(9 + k), 2 if k == 0 else 0) for k in range(4)]

    def test_earliest_value_wins(self, spark):
        rows = [("a", "pr", dt.datetime(2026, 1, 2), 1.0), ("a", "pr", dt.datetime(2026, 1, 1), 9.0), ("a", "pr", dt.datetime(2025, 1, 1), None), ("b", "tas", dt.datetime(2026, 1, 1), 3.0)]
        wide = no.widen_vars(spark.createDataFrame(rows, "cell string, var string, init_ts timestamp, value double"), ["pr", "tas"])
        assert {r["cell"]: (r["pr"], r["tas"]) for r in wide.collect()} == {"a": (9.0, None), "b": (None, 3.0)}

    def test_rank_over_blocks(self, spark):
        df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x")).repartition(5)
        got = {r["x"]: r["n"] for r in global_rank(df, [F.col("x").desc()], "n").collect()}
        assert [got[x] for x in sorted(got, reverse=True)] == list(range(1, 1001))
        batches = ct.chunk(df.select(F.col("x").alias("path")), 300).groupBy("batch", "batches").count().collect()
        assert sorted(map(tuple, batches)) == [(1, 4, 300), (2, 4, 300), (3, 4, 300), (4, 4, 100)]
        assert global_rank(df.limit(0), [F.col("x")], "n").count() == 0


def exchanges(df) -> int:
    """Shuffles in the physical plan before execution."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line for line in plan.splitlines())


class TestPlans:
    @pytest.fixture
    def hindcast(self, spark, tmp_path):
        rng = np.random.default_rng(2)
        rows = [("A", "pr", 0, 0.0, float(c), dt.date(2001, 1, 1) + dt.timedelta(int(d)), 1, float(v)) for c in range(3) for d, v in zip(rng.integers(0, 900, 60), rng.random(60), strict=True)]
        spark.createDataFrame(rows, "model string, var string, lead_ix int, lat double, lon double, init_date date, member int, value double").write.parquet(str(tmp_path / "h"))
        return spark.read.parquet(str(tmp_path / "h"))

    def test_climatology_shuffles_the_hindcast_once(self, hindcast):
        assert exchanges(cl.climatology(hindcast)) == 1

    def test_pools_shuffle_the_hindcast_once(self, hindcast):
        assert exchanges(th.pool_samples(hindcast)) == 1
        assert exchanges(th.thresholds(hindcast, 95, trim=False)) == 1

    def test_nearest_cells_leave_the_cube_where_it_is(self, spark, hindcast):
        plan = gr.nearest_cell(hindcast, targets(spark, (0, 1.2)))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan

    def test_stored_cubes_are_pruned(self, spark, tmp_path):
        rows = [("forecast", m, v, START, None, 1, 0, 0.5, START, None, 0.0, 0.0, 1.0) for m in ("A", "B") for v in ("pr", "tas")]
        cu.write_cube(spark.createDataFrame(rows, cu.SCHEMA), str(tmp_path / "c"))
        got = cu.read_cube(spark, str(tmp_path / "c"), "forecast", ["A"], ["pr"])
        assert len(got.select("*", "_metadata.file_path").select("file_path").distinct().collect()) == 1 and "PartitionFilters: [isnotnull" in got._jdf.queryExecution().toString()


class TestWorkingFolders:
    class Session:
        """What is asked of a session, without one."""

        def __init__(self, master, folder=None):
            settings = {"spark.checkpoint.dir": folder} if folder else {}
            conf = type("Conf", (), {"get": lambda _, k, d=None: settings.get(k, d)})()
            self.conf = conf
            self.sparkContext = type("Context", (), {"master": master, "getConf": lambda _: conf, "applicationId": f"{master}-{id(self)}"})()

    def test_a_cluster_needs_a_shared_folder(self):
        for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1000]", "k8s://h"):
            with pytest.raises(ValueError):
                shared_dir(self.Session(master))
            assert shared_dir(self.Session(master, "hdfs:///shared/")) == "hdfs:///shared"
        local = self.Session("local[4]")
        made = shared_dir(local)
        assert made.startswith("file:///") and shared_dir(local) == made != shared_dir(self.Session("local[4]"))


    def test_uneven_axes_equal_numpy(self, spark):
        rng = np.random.default_rng(5)
        lats = np.degrees(np.arcsin(np.polynomial.legendre.leggauss(12)[0]))  # Gaussian latitudes
        lons = np.sort(rng.choice(np.arange(0, 360, 0.7), 9, replace=False))
        field = rng.normal(size=(len(lats), len(lons)))
        src = spark.createDataFrame([("A", float(y), float(x), float(field[i, j])) for i, y in enumerate(lats) for j, x in enumerate(lons)], "model string, lat double, lon double, value double")
        ask = [(float(rng.uniform(lats[0], lats[-1])), float(rng.uniform(lons[0], lons[-1]))) for _ in range(40)]
        ask += [(float(lats[3]), float(lons[4])), (float(lats[0]), float(lons[-1])), (float(lats[0]) - 0.01, float(lons[2])), (float(lats[5]) + 1e-12, float(lons[1]))]
        got = values(gr.bilinear(src, targets(spark, *ask)))
        for y, x in ask:
            if y < lats[0]:
                assert got[y, x] is None
                continue
            rows = [np.interp(x, lons, field[i]) for i in range(len(lats))]
            assert abs(got[y, x] - np.interp(y, lats, rows)) < 1e-8

    def test_given_step_leaves_gaps_open(self, spark):
        src = plane(spark, [0, 1, 3], [0, 1])
        assert values(gr.bilinear(src, targets(spark, (2, 0.5)), 1, 1)) == {(2.0, 0.5): None}
        assert values(gr.bilinear(src, targets(spark, (2, 0.5))))[2.0, 0.5] is not None


class TestSelection:
    @pytest.mark.parametrize(("interval", "bins"), [(1 << 16, 1 << 10), (3, 4), (1, 2)])
    def test_quantiles_equal_numpy(self, spark, interval, bins):
        rng = np.random.default_rng(11)
        groups = {"normal": rng.normal(size=400), "ties": rng.integers(0, 4, 300).astype(float), "one": np.array([7.5]), "same": np.full(90, -2.0), "wide": np.concatenate([rng.normal(size=60) * 1e300, [-1.7e308, 1.7e308, 0.0, 5e-324]])}
        rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("none", None), ("none", float("nan")), ("normal", float("inf")), (None, 3.0), (None, 5.0)]
        df = spark.createDataFrame(rows, "g string, value double")
        qs = (0.0, 0.1, 0.33, 0.5, 0.66, 1.0)
        got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(df, ["g"], qs, interval=interval, bins=bins).collect()}
        assert set(got) == {*groups, "none", None} and got["none"] == (0, [None] * 6)
        for k, v in {**groups, None: np.array([3.0, 5.0])}.items():
            assert got[k][0] == len(v)
            if k != "wide":
                assert np.allclose(got[k][1], np.quantile(v, qs), rtol=1e-12)
            else:  # numpy's own differences overflow here
                assert got[k][1][0] == v.min() and got[k][1][-1] == v.max() and all(a <= b for a, b in zip(got[k][1], got[k][1][1:]))
        whole = exact_quantiles(df.where("g = 'normal'"), [], (0.5,), interval=interval, bins=bins).first()
        assert whole["n"] == 400 and abs(whole["q"][0] - np.median(groups["normal"])) < 1e-12

    @pytest.mark.parametrize(("q", "window"), [(0.05, 0), (0.5, 15), (0.95, 15), (1.0, 40), (0.3, 200)])
    def test_sliding_ranks_equal_sorted_pools(self, q, window):
        rng = np.random.default_rng(int(q * 100) + window)
        day, value = rng.integers(1, 367, 900), np.round(rng.normal(size=900), 1)
        value[rng.random(900) < 0.2] = np.nan
        day[day % 50 < 20] = 77  # stretches without samples, and a hot day
        days, found = sliding_ranks(day, value, q, window, 366, block=16)
        want = {}
        for d in range(1, 367):
            gap = np.abs(day - d)
            pool = np.sort(value[np.minimum(gap, 366 - gap) <= window])
            if len(pool):
                want[d] = pool[int(np.rint(q * (len(pool) - 1)))]
        assert days.tolist() == list(want) and np.array_equal(found, np.array(list(want.values())), equal_nan=True)

    def test_sliding_ranks_hold_each_sample_once(self):
        import tracemalloc

        n = 200_000
        rng = np.random.default_rng(1)
        day, value = rng.integers(1, 367, n), rng.normal(size=n)
        tracemalloc.start()
        sliding_ranks(day, value, 0.95, 15, 366)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 80 * n  # 31 copies of each sample would take 248 bytes for each

    def test_exceedance_deals_its_cells_once(self, spark):
        """Forecast and thresholds meet in one shuffle by cell; what follows keeps it (the first lead of a model is found from the same one)."""
        rows = [("A", "pr", m, i, START, 0.0, 0.0, 1.0) for m in (1, 2) for i in range(9)]
        f = spark.createDataFrame(rows, "model string, var string, member int, lead_ix int, valid_date date, lat double, lon double, value double")
        t = f.where("member = 1").select("model", "var", "lead_ix", "lat", "lon", F.lit(0.5).alias("threshold"))
        plan = ex.exceedance(f, t)._jdf.queryExecution().executedPlan().toString().splitlines()
        shuffles = [line for line in plan if "Exchange hashpartitioning" in line]
        # The cells, in either branch of the same plan (which Spark then runs once); the rest are a row for each model and variable.
        assert sum("_cell#" in line for line in shuffles) == 2 and not any("lat#" in line for line in shuffles)

    def test_a_sample_is_shuffled_once(self, spark):
        h = spark.createDataFrame([("A", "pr", 0, 0.0, 0.0, START, 1.0)], "model string, var string, lead_ix int, lat double, lon double, init_date date, value double")
        assert exchanges(th.thresholds(h, 95, trim=False)) == 1


class TestArchive:
    def test_staging_folders_go(self, spark, tmp_path):
        rows = [("forecast", "A", "pr", START + dt.timedelta(d), dt.datetime(2026, 3, 5) + dt.timedelta(d), 1, 0, 0.5, START, None, 0.0, 0.0, 1.0) for d in range(3)]
        land, root = spark.createDataFrame(rows, cu.SCHEMA), str(tmp_path / "arc")
        assert ar.sync_archive(land.limit(1), root).count() == 1
        ar.sync_archive(land, root)
        assert os.listdir(tmp_path) == ["arc"] and Archive(spark, root).read(cu.SCHEMA).count() == 3

    def test_policies(self, spark):
        report = spark.createDataFrame([("A", True), ("A", False), ("B", True), ("C", False)], "model string, ok boolean")
        policies = spark.createDataFrame([("A", "fail_on_missing"), ("B", "fail_on_missing"), ("C", "warn")], "model string, policy string")
        assert {r["model"]: (r["missing"], r["code"]) for r in va.policy_codes(report, policies).collect()} == {"A": (1, 1), "B": (0, 0), "C": (1, 0)}

    def test_runs_without_input(self, spark):
        day = lambda d: dt.date(2026, 3, d)
        inputs, runs = spark.createDataFrame([(day(5),), (day(5),)], "fcst_date date"), spark.createDataFrame([(day(5),), (day(6),)], "fcst_date date")
        assert {r["fcst_date"]: (r["inputs"], r["smoke_mode"]) for r in va.smoke_runs(inputs, runs, True).collect()} == {day(5): (2, False), day(6): (0, True)}
        assert va.smoke_runs(inputs, runs.limit(1), False).count() == 1
        with pytest.raises(Exception, match="no input for 2026-03-06"):
            va.smoke_runs(inputs, runs, False).collect()
