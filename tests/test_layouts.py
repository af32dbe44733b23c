"""Layouts that spare work: what they must not read, shuffle or rewrite, and their edge cases."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteoloom.functions import bitsets
from meteoloom.operators import anomaly as an
from meteoloom.operators import archive as ar
from meteoloom.operators import exceedance as ex
from meteoloom.operators import quality as qu
from meteoloom.sources import catalog as ct
from meteoloom.sources import cube as cu
from meteoloom.sources import references as rf
from meteoloom.sources.snapshots import Archive, Conflict

START = dt.date(2026, 3, 5)


def cells(spark, models=("A", "B"), starts=2, leads=4, kind="forecast", label=float, value=lambda m, d, i, y: 1.0 * d + i + y):
    rows = [
        (kind, m, "pr", START + dt.timedelta(d), dt.datetime(2026, 3, 5) + dt.timedelta(d), 1, i, label(i), START + dt.timedelta(d + i), 2, float(y), 0.0, value(m, d, i, y))
        for m in models for d in range(starts) for i in range(leads) for y in (0, 10)
    ]
    return spark.createDataFrame(rows, cu.SCHEMA)


def sizes(root):
    return {os.path.join(p, f): os.path.getsize(os.path.join(p, f)) for p, _, fs in os.walk(f"{root}/data") for f in fs}


def labels(archive, model, version=None):
    rows = archive.read(cu.SCHEMA, version).where(F.col("model") == model).select("lead_ix", "lead_days").distinct().collect()
    return [r["lead_days"] for r in sorted(rows)]


class TestOverlay:
    def made(self, spark, tmp_path, **more):
        root = str(tmp_path / "arc")
        archive = Archive(spark, root)
        archive.commit(0, archive.stage(cells(spark, **more))[1])
        return archive, root

    def test_no_file_is_written_and_a_rollback_takes_it_back(self, spark, tmp_path):
        archive, root = self.made(spark, tmp_path)
        before = sizes(root)
        due = ar.overlay_leads(spark, root, cu.SCHEMA, ar.shifted_labels())
        assert due.count() == 4 and archive.version() == 2
        assert labels(archive, "A") == [0.5, 1.5, 2.5, 3.5] and labels(archive, "A", 1) == [0, 1, 2, 3]
        assert ar.overlay_leads(spark, root, cu.SCHEMA, ar.shifted_labels()).count() == 0 and archive.version() == 2  # a rerun changes nothing
        grid = spark.createDataFrame([("B", 1.0, 7.0, 4)], "model string, first double, last double, n int")
        ar.overlay_leads(spark, root, cu.SCHEMA, ar.grid_labels(grid))
        assert labels(archive, "B") == [1, 3, 5, 7] and labels(archive, "A") == [0.5, 1.5, 2.5, 3.5]
        archive.roll_back(1)
        assert labels(archive, "B") == [0, 1, 2, 3] and sizes(root) == before

    def test_back_by_the_inverse_and_by_taking_the_overlay_off(self, spark, tmp_path):
        archive, root = self.made(spark, tmp_path)
        ar.overlay_leads(spark, root, cu.SCHEMA, ar.shifted_labels())
        ar.overlay_leads(spark, root, cu.SCHEMA, ar.shifted_labels(reverse=True))
        assert labels(archive, "A") == [0, 1, 2, 3]
        ar.overlay_leads(spark, root, cu.SCHEMA, ar.shifted_labels())
        off = ar.stored_labels(spark, root, cu.SCHEMA).select(*ar.FILE, F.lit(None).cast("array<float>").alias("leads"))
        archive.commit_labels(archive.version(), off)
        assert labels(archive, "A") == [0, 1, 2, 3] and archive.files().where("labels IS NOT NULL").isEmpty()

    def test_wrong_lengths_and_second_writers(self, spark, tmp_path):
        archive, root = self.made(spark, tmp_path)
        grid = spark.createDataFrame([("B", 0.0, 4.0, 5)], "model string, first double, last double, n int")
        with pytest.raises(Exception, match="number of leads differs"):
            ar.overlay_leads(spark, root, cu.SCHEMA, ar.grid_labels(grid))
        assert archive.version() == 1
        due = ar.stored_labels(spark, root, cu.SCHEMA).withColumn("leads", F.transform("leads", lambda x: x + 1))
        archive.commit_labels(1, due)
        with pytest.raises(Conflict):
            archive.commit_labels(1, due)
        assert labels(archive, "A") == [1, 2, 3, 4]

    def test_labels_of_a_reference_of_the_same_length(self, spark, tmp_path):
        archive, root = self.made(spark, tmp_path)
        ref = spark.createDataFrame([("A", [0.25, 1.25, 2.25, 3.25]), ("B", [9.0])], "model string, leads array<float>")
        ar.overlay_leads(spark, root, cu.SCHEMA, ar.aligned_labels(ref))
        assert labels(archive, "A") == [0.25, 1.25, 2.25, 3.25] and labels(archive, "B") == [0, 1, 2, 3]

    def test_rewrites_keep_the_labels_that_were_read(self, spark, tmp_path):
        """A sync rewrites the file of a backfilled slot, and a later delivery brings labels of its own; compaction resolves both."""
        archive, root = self.made(spark, tmp_path, value=lambda m, d, i, y: None if m == "A" and d else 1.0)
        ar.overlay_leads(spark, root, cu.SCHEMA, ar.shifted_labels())
        ar.sync_archive(cells(spark, starts=3, label=lambda i: i + 0.25), root)
        got = {(r["model"], (r["init_date"] - START).days): r["x"] for r in archive.read(cu.SCHEMA).where("lead_ix = 1").groupBy("model", "init_date").agg(F.min("lead_days").alias("x")).collect()}
        assert got == {("A", 0): 1.5, ("A", 1): 1.25, ("A", 2): 1.25, ("B", 0): 1.5, ("B", 1): 1.5, ("B", 2): 1.25}
        want = sorted(map(str, archive.read(cu.SCHEMA).collect()))
        archive.compact(cu.SCHEMA, most=0)
        assert sorted(map(str, archive.read(cu.SCHEMA).collect())) == want and archive.files().where("labels IS NOT NULL").isEmpty()

    def test_two_labels_at_one_position_raise(self, spark, tmp_path):
        archive = Archive(spark, str(tmp_path / "arc"))
        archive.commit(0, archive.stage(cells(spark).withColumn("lead_days", (F.col("lead_ix") + F.col("lat")).cast("float")))[1])
        with pytest.raises(Exception, match="two labels at one position"):
            ar.overlay_leads(spark, archive.root, cu.SCHEMA, ar.shifted_labels())


def scanned(df, what):
    """A metric of the executed scans of a plan, summed."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if name == "FileSourceScanExec" and node.metrics().contains(what):
            found += node.metrics().apply(what).value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


class TestFiles:
    def test_filters_on_names_choose_the_files(self, spark, tmp_path):
        from pyspark.sql.types import DoubleType, StructField, StructType

        from meteoloom.plans.layout_queries import name_files

        rows = [(v, m, START + dt.timedelta(d), float(d)) for v in ("pr", "tas") for m in ("G-A", "G-B-2") for d in range(3)]
        root = str(tmp_path / "in")
        name_files(spark.createDataFrame(rows, "var string, model string, init_date date, value double"), root)
        spark.createDataFrame([(99.0,)], StructType([StructField("value", DoubleType())])).coalesce(1).write.parquet(f"{root}/forecast/odd")
        got = cu.read_provider(spark, root, "value double")
        assert got.count() == 13 and got.where("var IS NULL").first()["value"] == 99
        assert {r["model"] for r in got.where("var = 'pr'").select("model", "group").collect()} == {"G-A", "G-B-2"}
        some = got.where((F.col("var") == "pr") & (F.col("model") == "G-B-2") & (F.col("init_date") > START))
        assert scanned(some, "numFiles") == 2 and sorted(r["value"] for r in some.collect()) == [1, 2]
        assert scanned(got, "numFiles") == 13

    def test_empty_files_are_found_in_footers(self, spark, tmp_path):
        root = str(tmp_path / "cube")
        gaps = lambda m, d, i, y: float("nan") if m == "A" and d == 0 or m == "B" and d == 1 and y == 10 else 1.0
        c = cells(spark, starts=3, value=gaps).withColumn("level", F.col("lat").cast("int"))
        cu.write_cube(c, root)
        counts = {(r["model"], (r["init_date"] - START).days): (r["cells"], r["filled"]) for r in cu.footer_counts(spark, root).collect()}
        assert counts == {("A", 0): (8, 0), ("A", 1): (8, 8), ("A", 2): (8, 8), ("B", 0): (8, 8), ("B", 1): (8, 4), ("B", 2): (8, 8)}
        for keys in (list(cu.FILE), ["kind", "model", "var"], [*cu.FILE, "level"], ["model", "var", "level", "init_date"], ["level"]):
            want = qu.drop_empty(cu.read_cube(spark, root), keys)
            assert sorted(map(str, cu.read_filled(spark, root, keys).collect())) == sorted(map(str, want.collect())), keys

    def test_footers_are_all_that_is_read(self, spark, tmp_path):
        root = str(tmp_path / "cube")
        cu.write_cube(cells(spark), root)
        plan = cu.count_in_footers(spark, root)._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*), COUNT(value)]" in plan
        assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def forecast(spark, n=3):
    rng = np.random.default_rng(5)
    rows = [(m, v, START, k, i, float(y), float(x), None if rng.random() < 0.1 else float(rng.integers(0, 9))) for m in "AB" for v in ("pr", "tas") for k in range(n) for i in range(5) for y in (-0.0, 0.5) for x in (10.0, 350.25)]
    return spark.createDataFrame(rows, "model string, var string, init_date date, member int, lead_ix int, lat double, lon double, value double")


class TestReferences:
    @pytest.fixture
    def stored(self, spark, tmp_path):
        f = forecast(spark)
        ref = f.where("member = 0 AND NOT (model = 'B' AND lead_ix > 2) AND NOT (lat = 0.5 AND lon = 10)").drop("member", "init_date")
        both = ref.withColumn("mmdd", F.lit("0305")).unionByName(ref.withColumns({"mmdd": F.lit("0306"), "value": F.col("value") + 5}))
        name = f"reference_{tmp_path.name}"
        rf.store_reference(both, name, 4, by=["mmdd"], path=str(tmp_path / "ref"))
        yield f, ref, name
        spark.sql(f"DROP TABLE {name}")

    def test_results_equal_the_plain_joins(self, spark, stored):
        f, ref, name = stored
        same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
        day = F.col("mmdd") == "0305"
        for per_member in (False, True):
            assert same(rf.anomaly_in_place(f, name, day, per_member), an.anomaly(f, ref, per_member=per_member))
        for direction in ("above", "below"):
            assert same(rf.crossings_in_place(f, name, day, direction), ex.crossings(f, ref.withColumnRenamed("value", "threshold"), direction))
        with pytest.raises(ValueError):
            rf.crossings_in_place(f, name, day, "beside")

    def test_the_reference_is_never_shuffled(self, spark, stored):
        f, _, name = stored
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            for out in (rf.anomaly_in_place(f, name, F.col("mmdd") == "0305"), rf.crossings_in_place(f, name, F.col("mmdd") == "0305")):
                plan = out._jdf.queryExecution().executedPlan().toString()
                assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan
                assert "PartitionFilters: [isnotnull(mmdd" in plan
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

    def test_two_values_of_a_cell_raise(self, spark, tmp_path):
        ref = forecast(spark, 2).drop("init_date")
        with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|Duplicate map key"):
            rf.store_reference(ref, f"twice_{tmp_path.name}", 2, path=str(tmp_path / "ref"))
        with pytest.raises(ValueError, match="no buckets"):
            spark.range(3).write.option("path", str(tmp_path / "t")).saveAsTable(f"plain_{tmp_path.name}")
            rf.buckets_of(spark, f"plain_{tmp_path.name}")


class TestWords:
    def test_sets_equal_python_sets(self, spark):
        rng = np.random.default_rng(3)
        keys = ["A", "B", None]
        left = {k: {int(x) for x in rng.integers(-300, 300, 150)} | {-64, -1, 0, 63, 64, 127} for k in keys}
        right = {k: {int(x) for x in rng.integers(-300, 300, 200)} for k in keys[1:]}
        frame = lambda s: spark.createDataFrame([(k, x) for k, v in s.items() for x in v for _ in range(2)] + [("A", None)] * (s is left), "k string, x int")
        a, b = (bitsets.words(frame(s), ["k"], F.col("x")) for s in (left, right))
        rows = lambda df: {k: {r["number"] for r in df.collect() if r["k"] == k} for k in keys}
        assert rows(bitsets.numbers(a, ["k"])) == left
        lack = bitsets.minus(a, b, ["k"])
        assert rows(bitsets.numbers(lack, ["k"])) == {k: left[k] - right.get(k, set()) for k in keys}
        assert {r["k"]: r["n"] for r in bitsets.counts(lack, ["k"]).collect()} == {k: len(left[k] - right.get(k, set())) for k in keys}
        for first, last in ((-64, -1), (0, 63), (-70, 65), (5, 5), (63, 64), (9, 8)):
            want = {k: {x for x in left[k] if first <= x <= last} for k in keys}
            near = bitsets.within(a, first, last)
            assert rows(bitsets.numbers(near, ["k"])) == want
            assert {r["k"]: r["number"] for r in bitsets.greatest_number(near, ["k"]).collect()} == {k: max(v) for k, v in want.items() if v}

    def test_members_of_all_variables(self, spark):
        rows = [("A", START, v, m) for v, ms in (("pr", (1, 2, 70)), ("tas", (2, 70, 71))) for m in ms] + [("B", START, "pr", 1), ("C", START, None, 5), ("C", START, "pr", 6)]
        m = spark.createDataFrame(rows, "model string, init_date date, var string, member int")
        own = lambda df: {(r["model"], r["number"]) for r in bitsets.numbers(df, ["model", "init_date"]).collect()}
        assert own(ct.complete_member_words(m)) == {(r["model"], r["member"]) for r in ct.complete_members(m.where("var IS NOT NULL")).collect()} == {("A", 2), ("A", 70), ("B", 1), ("C", 6)}
        assert own(ct.complete_member_words(m, 2)) == {("A", 2), ("A", 70)}
        lack = ct.member_words_to_fetch(m, ct.complete_member_words(m, 2))
        assert {(r["model"], r["member"]) for r in lack.collect()} == {("A", 1), ("A", 71), ("B", 1), ("C", 5), ("C", 6)}

    def test_empty_tables(self, spark):
        none = spark.createDataFrame([], "model string, var string, init_date date")
        assert ct.missing_starts(ct.start_words(none), ct.start_words(none)).isEmpty() and ct.newest_of_words(ct.start_words(none), "2026-03-05", 3).isEmpty()


class TestPackedFiles:
    """An archive's files follow its bytes, not its partitions."""

    def test_many_partitions_share_few_files(self, spark, tmp_path):
        archive = Archive(spark, str(tmp_path / "arc"))
        archive.commit(0, archive.stage(cells(spark, models=[f"M{i}" for i in range(30)], starts=4, leads=1))[1])
        assert archive.files().count() == 120 and len([f for f in sizes(archive.root) if f.endswith(".parquet")]) <= 4
        one = archive.read(cu.SCHEMA, where=(F.col("model") == "M7") & (F.col("init_date") > START))
        assert one.count() == 6 and {r["model"] for r in one.collect()} == {"M7"}

    def test_a_backfill_rewrites_no_neighbour(self, spark, tmp_path):
        root = str(tmp_path / "arc")
        archive = Archive(spark, root)
        value = lambda m, d, i, y: None if m == "A" and d == 1 else 1.0
        archive.commit(0, archive.stage(cells(spark, models="ABCD", value=value).coalesce(1))[1])
        before = sorted(map(str, archive.read(cu.SCHEMA, 1).collect()))
        ar.sync_archive(cells(spark, models="ABCD", value=lambda *x: 2.0), root)
        new = archive.files(2).join(archive.files(1).select("path").distinct(), "path", "left_anti")
        assert [(r["model"], r["init_date"]) for r in new.collect()] == [("A", START + dt.timedelta(1))]
        got = archive.read(cu.SCHEMA)
        assert got.count() == 64 and got.where("value = 2").select("model", "init_date").distinct().count() == 1 and got.where("value IS NULL").isEmpty()
        assert sorted(map(str, archive.read(cu.SCHEMA, 1).collect())) == before

    def test_a_slot_is_extended_while_its_neighbour_is_backfilled(self, spark, tmp_path):
        """Both lie in one partition, so the rows of the extended slot are written anew beside its new fields."""
        root = str(tmp_path / "arc")
        first = cells(spark, models="A", starts=1)
        noon = first.withColumn("init_ts", F.expr("init_ts + interval 12 hours"))
        ar.sync_archive(first.unionByName(noon.withColumn("value", F.lit(None).cast("double"))), root)
        both = first.unionByName(noon)
        plan = ar.sync_archive(both.unionByName(both.withColumn("member", F.lit(2))), root)
        assert {r["action"] for r in plan.collect()} == {"backfill", "extend"}
        got = Archive(spark, root).read(cu.SCHEMA)
        assert got.count() == 32 == got.select("init_ts", "member", "lead_ix", "lat").distinct().count() and got.where("value IS NULL").isEmpty()

    def test_compaction_leaves_no_dead_rows(self, spark, tmp_path):
        archive = Archive(spark, str(tmp_path / "arc"))
        archive.commit(0, archive.stage(cells(spark, models="ABCD", starts=1).coalesce(1))[1])
        archive.commit(1, archive.stage(cells(spark, models="E"))[1], archive.files(1).where("model <> 'D'"))
        want = sorted(map(str, archive.read(cu.SCHEMA).collect()))
        archive.compact(cu.SCHEMA)
        assert sorted(map(str, archive.read(cu.SCHEMA).collect())) == want and len(want) == 24
        assert archive.files().groupBy("path").agg(F.count("*").alias("n"), F.max("of").alias("of")).where("n < of").isEmpty()


class TestFewReads:
    """What a query reads, and how often."""

    def test_exceedance_finds_ends_and_days_in_one_pass_each(self, spark, tmp_path):
        rows = [("A", "pr", m, i, START, 0.0, 0.0, 1.0) for m in (1, 2) for i in range(9)]
        spark.createDataFrame(rows, "model string, var string, member int, lead_ix int, valid_date date, lat double, lon double, value double").write.parquet(str(tmp_path / "f"))
        f = spark.read.parquet(str(tmp_path / "f"))
        t = spark.createDataFrame([("A", "pr", i, 0.0, 0.0, 0.5) for i in range(9)], "model string, var string, lead_ix int, lat double, lon double, threshold double")
        plan = ex.exceedance(f, t)._jdf.queryExecution().executedPlan().toString()
        # Cells, ends and days, in either branch of the same plan (which Spark then runs once).
        assert sum("FileScan parquet" in line for line in plan.splitlines()) <= 6

    def test_exceedance_of_gaps_and_odd_members(self, spark):
        """A member without a number has no series, and days without a threshold are no positions of a cell."""
        value = lambda m, i: None if i in (0, 8) else float((m or 0) * i)
        rows = [("A", "pr", m, i, START + dt.timedelta(i), y, 0.0, value(m, i)) for m in (1, 2, None) for i in range(9) for y in (0.0, 10.0) if (m, i) != (2, 4)]
        f = spark.createDataFrame(rows, "model string, var string, member int, lead_ix int, valid_date date, lat double, lon double, value double")
        t = spark.createDataFrame([("A", "pr", i, 0.0, 0.0, 5.5) for i in (1, 2, 3, 5, 6)], "model string, var string, lead_ix int, lat double, lon double, threshold double")
        got = ex.exceedance(f, t, window=2)
        # Position p is day p + 1: member 1 crosses at 5 (day 6), member 2 at 2 (day 3) and, without day 4, at 5 and 6.
        want = {2: (1, 2), 3: (1, 2), 5: (2, 2), 6: (2, 2)}
        assert {r["lead_ix"]: (r["count"], r["members"]) for r in got.collect()} == want

    def test_gaps_are_found_in_one_pass_over_the_archive(self, spark):
        seen = spark.sparkContext.accumulator(0)
        archive = cells(spark, models="A", starts=3).unionByName(cells(spark, models="A", starts=2).withColumn("var", F.lit("tas")))
        counted = F.udf(lambda v: seen.add(1) or v, "string").asNondeterministic()
        land = cells(spark, models="A", starts=3).withColumn("var", F.lit("tas"))
        due = ar.repair_gaps(archive.withColumn("var", counted("var")), land)
        assert due.count() == 8 and seen.value == 40
