"""Percentile thresholds from pooled hindcast samples."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import circular_days, mmdd, mmdd_to_doy
from ..functions.selection import sliding_ranks

YEAR = 366


def nearest_rank(entries: Column, q: float) -> Column:
    """A3: the k-th smallest of sorted entries, k = round-half-even(q (n - 1)).

    n counts missing entries, NaN here, which sort last, so the result may be missing (Q6).
    """
    k = (F.bround(F.lit(q) * (F.size(entries) - 1), 0) + 1).cast("int")
    return F.nanvl(F.element_at(entries, k), F.lit(None).cast("double"))


def pool_samples(hindcast: DataFrame, window: int = 15, keys=("model", "var", "lead_ix", "lat", "lon")) -> DataFrame:
    """Keys, doy, _pool: the samples (missing ones as NaN) whose start lies within ``window`` days of a day, around the year.

    The hindcast is shuffled once, by a hash of its keys. A series' days are laid out over the year, with
    its ends repeated beyond them, and a window over the days gathers each pool, so no sample
    travels more than once. Days without any sample near them are left out.
    """
    own, day = ["_series", *keys], mmdd_to_doy(mmdd(F.col("init_date")))
    sample = F.coalesce(F.col("value"), F.lit(float("nan")))
    dealt = hindcast.select(F.xxhash64(*keys).alias("_series"), *keys, day.alias("_day"), sample.alias("_s")).repartition("_series")
    daily = dealt.groupBy(*own, "_day").agg(F.collect_list("_s").alias("_samples"))
    series = daily.groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("_day", "_samples"))).alias("_days"))
    at = F.explode(F.sequence(F.lit(1 - window), F.lit(YEAR + window))).alias("_at")
    laid = series.select(*own, "_days", at).select(*own, "_at", F.try_element_at("_days", F.pmod(F.col("_at") - 1, F.lit(YEAR)) + 1).alias("_samples"))
    near = Window.partitionBy(*own).orderBy("_at").rowsBetween(-window, window)
    pools = laid.withColumn("_pool", F.collect_list("_samples").over(near)).where(F.col("_at").between(1, YEAR) & (F.size("_pool") > 0))
    return pools.select(*keys, F.col("_at").alias("doy"), F.flatten("_pool").alias("_pool"))


def thresholds(hindcast: DataFrame, pct: int, window: int = 15, first: int | None = None, last: int | None = None, trim: bool = True, keys=("model", "var", "lead_ix", "lat", "lon")) -> DataFrame:
    """Nearest-rank percentile of each key and target day: keys, pct, doy, mmdd, threshold.

    No pool is built: each series is shuffled and sorted once, and its window of days moves over marks on the
    sorted samples (``sliding_ranks``).

    With ``trim`` leads beyond those of the shortest start in a (model, var) pool are cut off.
    """
    if first is not None:
        hindcast = hindcast.where(F.year("init_date") >= first)
    if last is not None:
        hindcast = hindcast.where(F.year("init_date") <= last)
    own = hindcast.select(*keys, mmdd_to_doy(mmdd(F.col("init_date"))).cast("int").alias("_day"), F.col("value").cast("double").alias("_s"))

    def select(table: pa.Table) -> pa.Table:
        value = table.column("_s").to_numpy().astype(float)  # null comes as NaN
        doy, found = sliding_ranks(table.column("_day").to_numpy(), value, pct / 100, window, YEAR)
        same = {k: pa.repeat(table.column(k)[0], len(doy)) for k in keys}
        return pa.table({**same, "doy": pa.array(doy, pa.int32()), "threshold": pa.array(found, pa.float64(), from_pandas=True)})

    # A group is one series: the samples of one cell and lead, each of which comes once.
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.select(*keys).schema)
    ranked = own.where("_day is not null").groupBy(*keys).applyInArrow(select, f"{kinds}, doy int, threshold double")
    if trim:
        # A row for each model, variable and day of the year.
        ranked = ranked.join(F.broadcast(shortest_leads(hindcast, window)), ["model", "var", "doy"]).where("lead_ix < _least").drop("_least")
    out = ranked.select(*keys, F.lit(pct).alias("pct"), "doy", "threshold")
    return out.withColumn("mmdd", F.date_format(F.date_add(F.lit("1999-12-31").cast("date"), F.col("doy").cast("int")), "MMdd"))


def shortest_leads(hindcast: DataFrame, window: int = 15) -> DataFrame:
    """A3: model, var, doy, and how many leads every start in the day's pool has (a row for each series and day)."""
    own = hindcast.groupBy("model", "var", "init_date").agg((F.max("lead_ix") + 1).alias("_n"))
    day = own.groupBy("model", "var", mmdd_to_doy(mmdd(F.col("init_date"))).alias("_day")).agg(F.min("_n").alias("_n"))
    return day.select("model", "var", _targets(window).alias("doy"), "_n").groupBy("model", "var", "doy").agg(F.min("_n").alias("_least"))


def _targets(window: int) -> Column:
    """The days of the year within ``window`` of ``_day``, around the year's end."""
    offsets = F.sequence(F.lit(-window), F.lit(window))
    return F.explode(F.transform(offsets, lambda o: F.pmod(F.col("_day") - 1 + o, F.lit(YEAR)) + 1))


def nearest_mmdd(catalog: DataFrame, wanted: str | DataFrame, max_days: int | None = 7, keys=("model", "var", "pct")) -> DataFrame:
    """J4 (with ``max_days``) and J5 (None): for each key the catalog's label nearest to the wanted
    MMDD around leap year 2000, exact first, ties to the smaller label; labels that are no date
    rank last under J5 and are never taken under J4. A key without a label near enough is absent.

    ``catalog``: keys, mmdd. Returns keys, wanted, mmdd, distance.
    """
    if isinstance(wanted, str):
        catalog = catalog.select(*keys, "mmdd").distinct().withColumn("wanted", F.lit(wanted))
    else:
        catalog = catalog.select(*keys, "mmdd").distinct().join(wanted, [c for c in wanted.columns if c != "wanted"])
    d = F.when(F.col("mmdd") == F.col("wanted"), F.lit(0)).otherwise(circular_days(mmdd_to_doy(F.col("mmdd")), mmdd_to_doy(F.col("wanted"))))
    near = catalog.withColumn("distance", d)
    if max_days is not None:
        near = near.where(F.col("distance") <= max_days)
    w = Window.partitionBy(*keys, "wanted").orderBy(F.col("distance").asc_nulls_last(), "mmdd")
    return near.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*keys, "wanted", "mmdd", "distance")


def split_thresholds(df: DataFrame, existing: DataFrame, keys=("model", "var", "pct", "mmdd")) -> DataFrame:
    """Rows of the month-days that aren't stored yet, to be written with partitionBy('mmdd')."""
    return df.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def already_built(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """Entries (entry, stage, first_year, last_year) that some completed run lists.

    ``manifest``: stage, first_year, last_year, entries (array).
    """
    done = manifest.select("stage", "first_year", "last_year", F.explode("entries").alias("entry")).distinct()
    return entries.join(done, ["entry", "stage", "first_year", "last_year"], "left_semi")
