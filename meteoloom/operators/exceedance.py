"""Exceedance of thresholds over rolling windows and their pooled probability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL = ("model", "var", "lat", "lon")


def crossings(forecast: DataFrame, thresholds: DataFrame, direction: str = "above") -> DataFrame:
    """Adds ``crossed`` (0 or 1) by position and cell. Strict; missing on either side never crosses (Q5).

    ``thresholds``: model, var, lead_ix, lat, lon, threshold. Cells without one drop out.
    """
    if direction not in ("above", "below"):
        raise ValueError(f"direction must be 'above' or 'below', not {direction!r}")
    t = thresholds.select("model", "var", "lead_ix", "lat", "lon", "threshold")
    cross = F.col("value") > F.col("threshold") if direction == "above" else F.col("value") < F.col("threshold")
    return forecast.join(t, ["model", "var", "lead_ix", "lat", "lon"]).withColumn("crossed", F.coalesce(cross, F.lit(False)).cast("int"))


def rolling_flags(crossed: DataFrame, window: int = 7, aggregate: str = "any", min_days: int | None = None) -> DataFrame:
    """Per member and cell, windows of ``window`` leads labelled by the last one.

    Leads that a series lacks are absent rows; the range frame runs over positions, so they
    count as not crossed. Incomplete windows drop out. ``min_days`` overrides ``aggregate``.
    """
    bounds = crossed.groupBy("model", "var").agg(F.min("lead_ix").alias("_first"))
    return _flags(crossed, window, _needed(window, "above", aggregate, min_days), bounds)


def _needed(window: int, direction: str, aggregate: str, min_days: int | None) -> int:
    """How many days of a window must cross."""
    if direction not in ("above", "below"):
        raise ValueError(f"direction must be 'above' or 'below', not {direction!r}")
    if window < 1:
        raise ValueError("window must be at least 1")
    if aggregate not in ("any", "all"):
        raise ValueError(f"aggregate must be 'any' or 'all', not {aggregate!r}")
    return min_days if min_days is not None else (1 if aggregate == "any" else window)


def _flags(crossed: DataFrame, window: int, need: int, bounds: DataFrame, *dealt: str) -> DataFrame:
    """Flags of windows; ``bounds`` has each model's first lead (_first), ``dealt`` names the column by which the rows are dealt already."""
    w = Window.partitionBy(*dealt, *CELL, "member").orderBy("lead_ix").rangeBetween(1 - window, 0)
    out = crossed.withColumn("days", F.sum("crossed").over(w)).join(F.broadcast(bounds), ["model", "var"])
    return out.where(F.col("lead_ix") >= F.col("_first") + window - 1).withColumn("flag", (F.col("days") >= need).cast("int")).drop("_first")


def lead_spine(df: DataFrame) -> DataFrame:
    """All leads of a (model, var) for every member and cell, so that each window end has a row."""
    leads = df.select("model", "var", "lead_ix", "valid_date").distinct()
    full = df.select(*CELL, "member").distinct().join(F.broadcast(leads), ["model", "var"])
    return full.join(df.select(*CELL, "member", "lead_ix", "value"), [*CELL, "member", "lead_ix"], "left")


def exceedance(forecast: DataFrame, thresholds: DataFrame, window: int = 7, direction: str = "above", aggregate: str = "any", min_days: int | None = None) -> DataFrame:
    """Per model and window end the members whose window crosses (``count``), all members
    of it (``members``) and the probability in percent.

    F6 trims empty outer leads first. A threshold's lead counts the days since the model's own
    start, so positions restart at the first lead that is left: a model padded to the leads of
    others meets its thresholds from the first one on. ``valid_date`` tells the calendar day. A model
    without any value of a variable raises.
    """
    need = _needed(window, direction, aggregate, min_days)
    leads = _leads(forecast)
    ends = F.broadcast(leads.select("model", "var", "_lo", "_hi"))  # a row for each model and variable, as are the others that are broadcast here
    own = forecast.join(ends, ["model", "var"]).where(F.col("lead_ix").between(F.col("_lo"), F.col("_hi"))).withColumn("lead_ix", F.col("lead_ix") - F.col("_lo"))
    days = _cells(own, thresholds).join(F.broadcast(leads.select("model", "var", "_leads")), ["model", "var"])
    known = F.filter("_leads", lambda x: F.map_contains_key("_limits", x["lead_ix"]))
    days = days.withColumn("_days", F.transform(known, lambda x: F.struct(x["lead_ix"].alias("lead_ix"), x["valid_date"].alias("valid_date"), F.try_element_at("_limits", x["lead_ix"]).alias("_limit"))))
    # The first lead of a model is found from its cells, before they are laid out by member and day.
    bounds = days.groupBy("model", "var").agg(F.min(F.array_min("_days.lead_ix")).alias("_first"))
    each = days.select("_cell", *CELL, "_days", F.inline("_members")).select("_cell", *CELL, "member", "_values", F.inline("_days"))
    value, limit = F.try_element_at("_values", F.col("lead_ix")), F.col("_limit")
    cross = value > limit if direction == "above" else value < limit
    crossed = each.select("_cell", *CELL, "member", "lead_ix", "valid_date", F.coalesce(cross, F.lit(False)).cast("int").alias("crossed"))
    flags = _flags(crossed, window, need, bounds, "_cell")
    out = flags.groupBy("_cell", *CELL, "lead_ix", "valid_date").agg(F.sum("flag").alias("count"), F.count("*").alias("members")).drop("_cell")
    return out.withColumn("probability", 100 * F.col("count") / F.col("members"))


def _leads(forecast: DataFrame) -> DataFrame:
    """model, var, the first and last lead with a value (_lo, _hi), and the days between, counted from the first (_leads).

    A model without any value of a variable raises.
    """
    at = F.when(F.col("value").isNotNull(), F.col("lead_ix"))
    days = F.collect_set(F.struct("lead_ix", "valid_date"))
    ends = forecast.groupBy("model", "var").agg(F.count("value").alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi"), days.alias("_all"))
    empty = F.raise_error(F.concat_ws(" ", F.lit("no value at any lead:"), "model", "var"))
    good = ends.where(F.when(F.col("_n") > 0, F.lit(True)).otherwise(empty.cast("boolean")))
    inside = F.filter("_all", lambda x: x["lead_ix"].between(F.col("_lo"), F.col("_hi")))
    return good.select("model", "var", "_lo", "_hi", F.transform(inside, lambda x: F.struct((x["lead_ix"] - F.col("_lo")).alias("lead_ix"), x["valid_date"].alias("valid_date"))).alias("_leads"))


def _cells(forecast: DataFrame, thresholds: DataFrame) -> DataFrame:
    """One row for each cell of the forecast that has thresholds: ``_cell`` (a hash of it), its members with their values by lead, and thresholds by lead.

    Both tables meet in one shuffle by cell, which the windows and counts after it keep. A series' repeated rows count
    once, by their greatest value.
    """
    null = lambda t: F.lit(None).cast(t)
    left = forecast.select(*CELL, "member", F.col("lead_ix").cast("int").alias("lead_ix"), F.col("value").cast("double").alias("value"), F.lit(True).alias("_own"))
    right = thresholds.select(*CELL, null(forecast.schema["member"].dataType).alias("member"), F.col("lead_ix").cast("int").alias("lead_ix"), F.col("threshold").cast("double").alias("value"), F.lit(False).alias("_own"))
    rows = left.unionByName(right)
    # A hash of the cell, since Spark doesn't take a table dealt by coordinates as grouped by them (0.0 and -0.0).
    dealt = rows.withColumns({c: F.col(c) + F.lit(0.0) for c in ("lat", "lon")}).withColumn("_cell", F.xxhash64(*CELL)).repartition("_cell")
    each = dealt.groupBy("_cell", *CELL, "_own", "member", "lead_ix").agg(F.max("value").alias("value"))
    series = each.groupBy("_cell", *CELL, "_own", "member").agg(F.map_from_entries(F.collect_list(F.struct("lead_ix", "value"))).alias("_values"))
    members = F.collect_list(F.when(F.col("_own") & F.col("member").isNotNull(), F.struct("member", "_values")))
    cells = series.groupBy("_cell", *CELL).agg(members.alias("_members"), F.max_by("_values", F.when(~F.col("_own"), 1)).alias("_limits"))  # one row of thresholds
    return cells.where((F.size("_members") > 0) & F.col("_limits").isNotNull())


def pool_models(counts: DataFrame, nens: DataFrame) -> DataFrame:
    """Pooled probability over models: 100 x counts / true ensemble sizes.

    Only windows and cells that all models with counts share are kept (Q7). ``counts``: var,
    model, valid_date, lat, lon, count; ``nens``: model, nens.
    """
    models = counts.select("var", "model").distinct().groupBy("var").agg(F.count("*").alias("_all"))
    got = counts.join(F.broadcast(nens), "model").groupBy("var", "valid_date", "lat", "lon")
    pooled = got.agg(F.sum("count").alias("count"), F.sum("nens").alias("nens"), F.countDistinct("model").alias("_n"))
    same = pooled.join(F.broadcast(models), "var").where(F.col("_n") == F.col("_all")).drop("_n", "_all")
    return same.withColumn("probability", 100 * F.col("count") / F.col("nens"))


def pick_week_window(probs: DataFrame, weeks: DataFrame, max_days: int = 3) -> DataFrame:
    """For each week the window that ends on its last day, else the nearest one within
    ``max_days`` (ties to the earlier); a week without any has picked_date null.

    ``weeks``: week, week_end. Returns week, week_end, picked_date and the cells of the window.
    """
    ends = probs.select("valid_date").distinct()
    gap = F.abs(F.datediff("valid_date", "week_end"))
    w = Window.partitionBy("week").orderBy(gap, "valid_date")
    near = ends.join(F.broadcast(weeks), gap <= max_days)  # window ends x weeks, both a few dozen
    best = near.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("week", F.col("valid_date").alias("picked_date"))
    labelled = weeks.join(best, "week", "left")
    return labelled.join(probs, F.col("picked_date") == F.col("valid_date"), "left").drop("valid_date")


def exceedance_report(models: DataFrame, catalog: DataFrame, probs: DataFrame, wanted: str, max_days: int = 7) -> DataFrame:
    """Per (model, var) status, label, and mean and finite share of the probability.

    Status is missing_threshold, no_threshold_within_N_days or ok. ``models``: model, var;
    ``catalog``: model, var, mmdd; ``probs``: model, var, probability.
    """
    from .thresholds import nearest_mmdd

    keys = ["model", "var"]
    near = nearest_mmdd(catalog, wanted, max_days, keys).select(*keys, "mmdd", "distance")
    any_label = catalog.select(*keys).distinct().withColumn("_has", F.lit(True))
    stats = probs.groupBy(*keys).agg(F.avg("probability").alias("mean"), F.count("probability").alias("finite"), F.count("*").alias("total"))
    out = models.join(any_label, keys, "left").join(near, keys, "left").join(stats, keys, "left")
    status = F.when(F.col("_has").isNull(), "missing_threshold").when(F.col("mmdd").isNull(), f"no_threshold_within_{max_days}_days").otherwise("ok")
    return out.withColumn("status", status).drop("_has")
