"""Keeping an archive table in step with a landing table.

Both are cubes in long form. A slot is one (model, var, init_ts): it is filled, missing (no
value) or absent. Changes are computed as a frame of slots to write, staged as new files,
verified, and then committed as the next version of the archive (``sources/snapshots.py``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.snapshots import PARTS, SLOT, Archive, slot_counts
from ..sources.working import delete, discard, store
from .normalise import join_null_safe, pad_union


def slots(cube: DataFrame) -> DataFrame:
    """State of each slot: filled or missing."""
    return cube.groupBy(*SLOT).agg(F.when(F.count("value") > 0, "filled").otherwise("missing").alias("state"))


def add_vars(landing: DataFrame, archive: DataFrame) -> DataFrame:
    """M2: landing rows of variables that the archive's model lacks, at starts that it stores."""
    starts = archive.select("model", "init_ts").distinct()
    known = archive.select("model", "var").distinct()
    return landing.join(starts, ["model", "init_ts"], "left_semi").join(known, ["model", "var"], "left_anti").select(*landing.columns)


def append_starts(landing: DataFrame, archive: DataFrame) -> DataFrame:
    """M3: landing rows of starts after the newest that the archive's model stores (all of a new model)."""
    mark = archive.groupBy("model").agg(F.max("init_ts").alias("_mark"))
    new = landing.join(F.broadcast(mark), "model", "left").where(F.col("_mark").isNull() | (F.col("init_ts") > F.col("_mark")))
    return new.select(*landing.columns)


def fill_slots(cube: DataFrame) -> DataFrame:
    """M4: the state of every (start, variable) of a model; a pair without rows is missing."""
    starts = cube.select("model", "init_date", "init_ts").distinct()
    variables = cube.select("model", "var").distinct()
    spine = starts.join(variables, "model")
    s = slots(cube)
    return join_null_safe(spine, s, SLOT, "left").select(*SLOT, F.coalesce("state", F.lit("missing")).alias("state"))


def backfill(landing: DataFrame, archive: DataFrame, n: int = 4) -> DataFrame:
    """M5: landing rows for the last n starts whose slot is missing in the archive and filled in landing.

    Slots are matched by init_ts, so a sub-daily start gets its own data (Q9).
    """
    from ..sources.catalog import latest_starts

    recent = latest_starts(archive, n)
    open_ = fill_slots(archive).where("state = 'missing'").join(recent, ["model", "init_date"], "left_semi").select(*SLOT)
    ready = slots(landing).where("state = 'filled'").select(*SLOT)
    due = open_.join(ready, list(SLOT), "left_semi")
    return landing.join(due, list(SLOT), "left_semi").select(*landing.columns)


def plan_slots(landed: DataFrame, held: DataFrame, n: int = 4) -> DataFrame:
    """M2-M6: SLOT, cells, action, fields: the slots that a sync would write, from the ``slot_counts`` of both sides.

    append: later than all that the model stores; add_var: a new variable at a stored start; backfill: one of the last
    n starts, missing here and filled there; extend: a filled slot that lacks some of the fields
    (member and lead) that have landed. ``fields`` are those to write.
    """
    from ..sources.catalog import latest_starts

    mark = held.groupBy("model").agg(F.max("init_ts").alias("_mark"))
    known = held.select("model", "var").distinct().withColumn("_known", F.lit(True))
    starts = held.select("model", "init_ts").distinct().withColumn("_start", F.lit(True))
    recent = latest_starts(held, n).select("model", "init_date").distinct().withColumn("_recent", F.lit(True))
    own = held.select(*SLOT, F.col("filled").alias("_filled"), F.col("fields").alias("_fields"))
    s = landed.join(mark, "model", "left").join(known, ["model", "var"], "left").join(starts, ["model", "init_ts"], "left").join(recent, ["model", "init_date"], "left")
    s = join_null_safe(s, own, SLOT, "left")
    fresh = F.when(F.col("_filled") > 0, F.array_except("fields", "_fields")).otherwise(F.col("fields"))
    action = (
        F.when(F.col("_mark").isNull() | (F.col("init_ts") > F.col("_mark")), "append")
        .when(F.col("_known").isNull() & F.col("_start"), "add_var")
        .when(F.col("_known") & F.col("_start") & F.col("_recent") & (F.coalesce("_filled", F.lit(0)) == 0) & (F.col("filled") > 0), "backfill")
        .when((F.col("_filled") > 0) & (F.size(fresh) > 0), "extend")
    )
    return s.select(*SLOT, "cells", action.alias("action"), fresh.alias("fields")).where(F.col("action").isNotNull())


def sync_plan(landing: DataFrame, archive: DataFrame, n: int = 4) -> DataFrame:
    """M6 (dry run): slots that a sync would write, with the action. Both tables are read once."""
    landed, held = (store(slot_counts(df), "slots") for df in (landing, archive))
    return plan_slots(landed, held, n).drop("fields")


def verify(staged: DataFrame, expected: DataFrame) -> DataFrame:
    """M6: slots whose staged rows or fields aren't the expected ones (both: SLOT, cells, fields; null cells: any number)."""
    got = staged.select(*SLOT, F.col("cells").alias("_cells"), F.array_sort("fields").alias("_fields"))
    named = expected.select(*SLOT, "cells", F.array_sort("fields").alias("fields")).withColumnsRenamed({k: f"_e_{k}" for k in SLOT})
    both = got.join(named, [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in SLOT], "full")
    same = F.col("_fields").eqNullSafe(F.col("fields")) & (F.col("cells").isNull() | F.col("cells").eqNullSafe(F.col("_cells")))
    return both.where(~same)


def sync_archive(landing: DataFrame, root: str, n: int = 4, dry_run: bool = False, skip_empty: bool = False) -> DataFrame:
    """M1-M6 on an ``Archive``: returns the plan that was carried out, a table in the shared folder.

    The plan comes from the slots of the landing table and those that the archive's list names. New
    rows are written as files that no version names; only if every slot has its rows there
    they become part of the archive, all in one version. Until then, and after any failure, readers see
    the version before. If another writer commits first this raises ``Conflict`` and writes nothing.
    A partition is rewritten only if a backfilled slot lies in it beside others, or less than half of its file would stay. With ``skip_empty`` files (model, var, init_date) without
    any value stay out.
    """
    spark = landing.sparkSession
    archive = Archive(spark, root)
    base = archive.version()
    landed = store(slot_counts(landing), "slots")
    some = join_null_safe(landed, landed.where("filled > 0").select(*PARTS).distinct(), PARTS, "left_semi") if skip_empty else landed
    plan = store(plan_slots(some, archive.slots(base), n), "sync-plan")
    discard(landed)
    if dry_run or plan.isEmpty():
        return plan.drop("fields")
    # An extended slot gets some of its fields, any other all that have landed.
    rows = join_null_safe(landing, plan.where("action <> 'extend'").select(*SLOT), SLOT, "left_semi")
    extended = plan.where("action = 'extend'").select(*SLOT, F.explode("fields").alias("_field"))
    if not extended.isEmpty():
        field = F.struct(F.col("member").cast("int").alias("member") if "member" in landing.columns else F.lit(None).cast("int").alias("member"), F.col("lead_ix").cast("int").alias("lead_ix"))
        rows = rows.unionByName(join_null_safe(landing.withColumn("_field", field), extended, [*SLOT, "_field"], "left_semi").drop("_field"))
    # Partitions of slots that are replaced, and what then is left of files of which less than half stays: what else they hold is written anew.
    replaced = plan.where("action = 'backfill'").select(*SLOT)
    held = archive.files(base).select("path", "labels", "of", *PARTS, F.explode("slots.init_ts").alias("init_ts"))
    marked = join_null_safe(held, replaced.withColumn("_gone", F.lit(True)), SLOT, "left")
    each = marked.groupBy("path", *PARTS).agg(F.first("labels").alias("labels"), F.first("of").alias("of"), F.count("_gone").alias("_gone"), F.count("*").alias("_all"))
    thin = each.groupBy("path").agg(F.count_if(F.col("_gone") == 0).alias("_live"), F.sum("_gone").alias("_n"), F.max("of").alias("_of")).where("_n > 0 AND 2 * _live < _of").select("path", F.lit(True).alias("_thin"))
    old = store(each.join(thin, "path", "left").where("_gone > 0 OR _thin"), "archive-old")
    kept, made, new = old.where("_gone < _all"), [], []
    try:
        for cells in (rows, None if kept.isEmpty() else join_null_safe(archive.read_files(kept, landing.schema), replaced, SLOT, "left_anti")):
            if cells is not None:
                folder, files = archive.stage(cells)
                made.append(folder)
                new.append(files)
        wanted = plan.select(*SLOT, F.when(F.col("action") != "extend", F.col("cells")).alias("cells"), "fields")
        bad = verify(new[0].select(*PARTS, F.inline("slots")).groupBy(*SLOT).agg(F.sum("cells").alias("cells"), F.array_distinct(F.flatten(F.collect_list("fields"))).alias("fields")), wanted)
        if not bad.isEmpty():
            raise RuntimeError("staged rows don't match the plan; the archive is unchanged")
        archive.commit(base, reduce(DataFrame.unionByName, new), old)
    except BaseException:
        for folder in made:
            delete(spark, folder)
        raise
    finally:
        discard(*new, old)
    return plan.drop("fields")


def lagging(archive: DataFrame) -> DataFrame:
    """M7: variables behind their model's newest start, by how many slots (gap) and which."""
    starts = archive.select("model", "init_ts").distinct()
    own = archive.select("model", "var", "init_ts").distinct()
    variables = own.select("model", "var").distinct()
    lack = variables.join(starts, "model").join(own, ["model", "var", "init_ts"], "left_anti")
    return lack.groupBy("model", "var").agg(F.count("*").alias("gap"), F.max("init_ts").alias("missing_ts"))


def repair_gaps(archive: DataFrame, landing: DataFrame) -> DataFrame:
    """M7: landing rows for variables that lag by exactly the newest slot; any other gap raises.

    The archive is read once, for its slots.
    """
    own = store(archive.select("model", "var", "init_ts").distinct(), "gap-slots")
    newest = own.groupBy("model").agg(F.max("init_ts").alias("_newest"))
    state = store(lagging(own).join(newest, "model"), "gaps")
    discard(own)
    if not state.where((F.col("gap") != 1) | (F.col("missing_ts") != F.col("_newest"))).isEmpty():
        raise RuntimeError("a variable lags by more than its newest slot; repair aborted")
    due = state.select("model", "var", F.col("missing_ts").alias("init_ts"))
    return landing.join(due, ["model", "var", "init_ts"], "left_semi").select(*landing.columns)


def replace_leads(archive: DataFrame, grid: DataFrame) -> DataFrame:
    """M8: lead labels of a model from its authoritative grid (model, first, last, n).

    A model whose number of leads isn't n raises; models without a grid keep their labels.
    """
    have = archive.groupBy("model").agg((F.max("lead_ix") + 1).alias("_n"))
    if not have.join(grid, "model").where("_n != n").isEmpty():
        raise RuntimeError("the number of leads isn't the grid's")
    g = grid.select("model", F.col("first").alias("_first"), ((F.col("last") - F.col("first")) / F.greatest(F.lit(1), F.col("n") - 1)).alias("_step"))
    out = archive.join(F.broadcast(g), "model", "left")
    label = F.coalesce(F.col("_first") + F.col("lead_ix") * F.col("_step"), F.col("lead_days"))
    return out.withColumn("lead_days", label.cast("float")).select(*archive.columns)


def canonical_leads(grid: DataFrame) -> DataFrame:
    """grid (model, first, n) -> model, canon (array of labels): first, first + 1, ... (n of them)."""
    return grid.select("model", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: (i + F.col("first")).cast("float")).alias("canon"))


def lead_files(cube: DataFrame, dtype: str = "float32") -> DataFrame:
    """One row for each file: model, kind, var, init_date, its sorted labels and their type."""
    return cube.groupBy("model", "kind", "var", "init_date").agg(F.array_sort(F.collect_set("lead_days")).alias("leads")).withColumn("lead_dtype", F.lit(dtype))


def audit_leads(files: DataFrame, canon: DataFrame) -> DataFrame:
    """M9: status of each file's labels: unreadable, dtype_mismatch, length_mismatch, ok or relabel."""
    f = files.join(F.broadcast(canon), "model", "left")
    status = (
        F.when(F.col("leads").isNull() | F.col("canon").isNull(), "unreadable")
        .when(F.col("lead_dtype") != "float32", "dtype_mismatch")
        .when(F.size("leads") != F.size("canon"), "length_mismatch")
        .when(F.col("leads") == F.col("canon"), "ok")
        .otherwise("relabel")
    )
    return f.withColumn("status", status)


FILE = ("model", "kind", "var", "init_date")


def relabel_leads(cube: DataFrame, audit: DataFrame) -> DataFrame:
    """Canonical labels for files that the audit wants relabelled and that still have the
    audited labels (compare and set); all other files come back unchanged."""
    now = lead_files(cube).select(*FILE, F.col("leads").alias("_now"))
    due = audit.where("status = 'relabel'").join(now, list(FILE)).where(F.col("leads") == F.col("_now")).select(*FILE, "canon")
    out = cube.join(due, list(FILE), "left")
    return out.withColumn("lead_days", F.coalesce(F.get("canon", F.col("lead_ix")), F.col("lead_days"))).select(*cube.columns)


def revert_log(audit: DataFrame) -> DataFrame:
    """The audit with old and new labels swapped; relabelling by it takes the change back."""
    return audit.where("status = 'relabel'").select(*FILE, F.col("canon").alias("leads"), F.col("leads").alias("canon"), "status")


def relabel_archive(spark: SparkSession, root: str, schema, audit: DataFrame, log: str, apply: bool = True, relabel=relabel_leads) -> DataFrame:
    """M10 on an ``Archive``: FILE and result for each file that the audit wants relabelled.

    would_relabel (without ``apply``), changed_since_audit (its labels aren't the audited ones any more), relabelled, or
    verify_failed_reverted. The revert log is stored first, under ``log``. Files are rewritten beside the archive; those whose
    labels come out canonical and whose data are unmoved (A20) become one new version, the others never do. A writer
    that commits in between makes this raise ``Conflict``, with the archive as that writer left it.
    """
    archive = Archive(spark, root)
    base = archive.version()
    due = audit.where("status = 'relabel'").select(*FILE, "leads", "canon", "status")
    parts = due.select(*PARTS).distinct().withColumnsRenamed({k: f"_{k}" for k in PARTS})
    old = store(archive.files(base).join(parts, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in PARTS], "left_semi").select("path", *PARTS, "slots", "labels", "of"), "archive-old")
    cells = archive.read_files(old, schema)
    now = lead_files(cells).select(*FILE, F.col("leads").alias("_now"))
    state = store(join_null_safe(due, now, FILE).withColumn("_same", F.col("leads") == F.col("_now")), "relabel-state")
    name = lambda ok: F.when(~F.col("_same"), "changed_since_audit").when(ok, "relabelled" if apply else "would_relabel").otherwise("verify_failed_reverted")
    if not apply or state.where("_same").isEmpty():
        return state.select(*FILE, name(F.lit(True)).alias("result"))
    revert_log(state.where("_same")).write.mode("append").parquet(log)
    after = store(relabel(cells, state.where("_same").select(*FILE, "leads", "canon", "status")), "relabelled")
    new = lead_files(after).select(*FILE, F.col("leads").alias("_new"))
    moved = lambda df, c: fingerprint(df, FILE).select(*FILE, F.struct("cells", "digest").alias(c))
    marks = join_null_safe(join_null_safe(state, new, FILE, "left"), join_null_safe(moved(cells, "_was"), moved(after, "_is"), FILE, "left"), FILE, "left")
    ok = F.coalesce((F.col("_new") == F.col("canon")) & (F.col("_was") == F.col("_is")), F.lit(False))
    result = store(marks.select(*FILE, name(ok).alias("result")), "relabel-result")
    done = result.where("result = 'relabelled'").select(*FILE)
    folder, staged = archive.stage(join_null_safe(after, done, FILE, "left_semi").unionByName(join_null_safe(cells, done, FILE, "left_anti")))
    try:
        archive.commit(base, staged, old)
    except BaseException:
        delete(spark, folder)
        raise
    finally:
        discard(old, staged, state, after)
    return result


def stored_labels(spark: SparkSession, root: str, schema, version: int | None = None) -> DataFrame:
    """FILE, leads of an archive: the labels that readers see, by position (null where a position has no row).

    Only the label columns are read. A file whose position has two labels raises, as no list by position holds them.
    """
    cells = Archive(spark, root).read(schema, version)
    each = cells.groupBy(*FILE, "lead_ix").agg(F.min("lead_days").alias("_lo"), F.max("lead_days").alias("_hi"))
    torn = F.raise_error(F.concat_ws(" ", F.lit("two labels at one position:"), *FILE))
    label = F.when(F.col("_lo").eqNullSafe(F.col("_hi")), F.col("_lo")).otherwise(torn.cast("float"))
    lists = each.groupBy(*FILE).agg(F.map_from_entries(F.collect_list(F.struct("lead_ix", label.alias("label")))).alias("_of"), F.max("lead_ix").alias("_last"))
    return lists.select(*FILE, F.transform(F.sequence(F.lit(0), "_last"), lambda i: F.try_element_at("_of", i)).alias("leads"))


def overlay_leads(spark: SparkSession, root: str, schema, change) -> DataFrame:
    """M8, M11, P22 on an ``Archive`` without rewriting a cell: returns the files whose labels differ now: FILE, was, leads.

    ``change`` maps FILE, leads (labels by position) to FILE, leads: ``grid_labels``, ``shifted_labels``, ``aligned_labels`` or one's own.
    The new labels are part of the next version's list, so readers see all of them or none, ``roll_back`` takes them back,
    and a writer that commits in between makes this raise ``Conflict``. A file whose new list has another length raises.
    """
    archive = Archive(spark, root)
    base = archive.version()
    now = store(stored_labels(spark, root, schema, base), "labels")
    named = change(now).select(*FILE, F.col("leads").cast("array<float>").alias("_to"))
    both = join_null_safe(now.withColumnRenamed("leads", "was"), named, FILE)
    wrong = F.raise_error(F.concat_ws(" ", F.lit("the number of leads differs:"), *FILE))
    to = F.when(F.size("was") == F.size("_to"), F.col("_to")).otherwise(wrong.cast("array<float>"))
    due = store(both.select(*FILE, "was", to.alias("leads")).where(~F.col("was").eqNullSafe(F.col("leads"))), "labels-due")
    discard(now)
    if not due.isEmpty():
        archive.commit_labels(base, due)
    return due


def grid_labels(grid: DataFrame):
    """M8 for ``overlay_leads``: the labels of each model's authoritative grid (model, first, last, n).

    Models without a grid keep theirs.
    """
    step = (F.col("last") - F.col("first")) / F.greatest(F.lit(1), F.col("n") - 1)
    lists = grid.withColumn("_step", step).select("model", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.col("first") + i * F.col("_step")).alias("leads"))
    return lambda files: files.drop("leads").join(lists, "model")


def shifted_labels(by: float = 0.5, reverse: bool = False):
    """M11 for ``overlay_leads``: whole numbers 0..n-1 become by..n-1+by, back with ``reverse``; all other labels stay."""
    take, give = (by, 0.0) if reverse else (0.0, by)
    return lambda files: files.withColumn("leads", F.transform("leads", lambda x, i: F.when(x == i.cast("float") + F.lit(take).cast("float"), i + F.lit(give)).otherwise(x).cast("float")))


def aligned_labels(ref: DataFrame):
    """P22 for ``overlay_leads``: labels of the reference (model, leads) for files of the same length; others keep theirs."""
    own = ref.select("model", F.col("leads").alias("_ref"))
    return lambda files: files.join(own, "model").withColumn("leads", F.when(F.size("leads") == F.size("_ref"), F.col("_ref")).otherwise(F.col("leads")))


def shift_leads(cube: DataFrame, by: float = 0.5, reverse: bool = False) -> DataFrame:
    """Whole-number labels 0..n-1 become by..n-1+by, and back with ``reverse``. Files that
    already have the target's labels stay, so a rerun changes nothing."""
    base = F.col("lead_ix").cast("float")
    source, target = (base + F.lit(by), base) if reverse else (base, base + F.lit(by))
    return cube.withColumn("lead_days", F.when(F.col("lead_days") == source, target).otherwise(F.col("lead_days")).cast("float"))


def unexpected_leads(cube: DataFrame, by: float = 0.5) -> DataFrame:
    """Files with labels that are neither 0..n-1 nor by..n-1+by."""
    base = F.col("lead_ix").cast("float")
    odd = (F.col("lead_days") != base) & (F.col("lead_days") != base + F.lit(by))
    return cube.groupBy(*FILE).agg(F.count_if(odd).alias("odd")).where("odd > 0")


def merge_members(old: DataFrame, new: DataFrame) -> DataFrame:
    """Good members of the old start stay, the others come from the new one; leads are padded to their union."""
    key = ["model", "var", "init_date", "member"]
    good = old.groupBy(*key).agg(F.count("value").alias("_n")).where("_n > 0").drop("_n")
    kept = old.join(good, key, "left_semi").select(*old.columns)
    return pad_union(kept.unionByName(new.join(good, key, "left_anti").select(*old.columns)), "lead_ix")


def fingerprint(cube: DataFrame, keys=("model", "var")) -> DataFrame:
    """Rows and an order-free sum of cell hashes for each key, to prove that data are untouched."""
    cells = F.xxhash64(*[c for c in cube.columns if c not in ("lead_days",)])
    return cube.groupBy(*keys).agg(F.count("*").alias("cells"), F.sum(cells.cast("decimal(38,0)")).alias("digest"))
