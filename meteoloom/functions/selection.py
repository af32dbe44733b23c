"""Order statistics without a sort of whole groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.working import discard, store

#: Distinct values of an interval that one task may sort, and intervals that a larger one is cut into.
INTERVAL = 1 << 16
BINS = 1 << 10


def exact_quantiles(df: DataFrame, keys, qs, value: str = "value", interval: int = INTERVAL, bins: int = BINS) -> DataFrame:
    """keys, n, q: how many finite values a group has, and its quantiles (array<double>, linearly interpolated).

    Equal values are counted first, which spreads a group by its values. Each wanted rank then narrows its
    interval: values in it are counted by ``bins`` equal parts, and the part that holds the rank is the next
    interval, down to at most ``interval`` distinct values or a single one. Only that rest is ordered in a task, so a group
    may hold any number of rows. Missing and non-finite values don't count; a group without others has null quantiles.
    """
    keys = list(keys)
    own = [f"_k{i}" for i in range(len(keys))]
    named = df.select(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], F.col(value).cast("double").alias("_v"))
    counted = store(named.where("_v is not null and abs(_v) < double('infinity')").groupBy(*own, "_v").agg(F.count("*").alias("_c")), "quantile-values")
    sizes = counted.groupBy(*own).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_d"))
    rank = lambda q, up: (F.ceil if up else F.floor)(F.lit(float(q)) * (F.col("_n") - 1)).cast("long")
    ranks = F.array_distinct(F.array(*[rank(q, up) for q in qs for up in (False, True)]))
    state = store(sizes.select(*own, F.explode(ranks).alias("_r"), F.lit(0).cast("long").alias("_before"), "_lo", "_hi", "_d"), "quantile-ranks")
    same = lambda a, b: [a[o].eqNullSafe(b[f"_t{o}"]) for o in own]
    within = lambda t: t.withColumnsRenamed({o: f"_t{o}" for o in own})

    def held(targets: DataFrame) -> DataFrame:
        t = within(targets)
        on = same(counted, t)
        rows = counted.join(t, on) if on else counted.crossJoin(t)  # without keys there are as many targets as ranks
        return rows.where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop(*[f"_t{o}" for o in own])

    wide = (F.col("_d") > interval) & (F.col("_lo") < F.col("_hi"))
    while not state.where(wide).isEmpty():
        # The ends never share a part, so every pass narrows. A width that overflows is halved.
        width = F.col("_hi") - F.col("_lo")
        part = F.when(width < F.lit(float("inf")), (F.col("_v") - F.col("_lo")) / width).otherwise((F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2))
        bin_ = F.least(F.lit(bins - 1), F.floor(part * bins)).cast("int")
        counts = held(state.where(wide)).groupBy(*own, "_r", "_before", bin_.alias("_bin")).agg(F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_d"))
        upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*own, "_r").orderBy("_bin"))
        chosen = counts.withColumn("_upto", upto).where((F.col("_r") < F.col("_upto")) & (F.col("_r") >= F.col("_upto") - F.col("_c")))
        chosen = chosen.select(*own, "_r", (F.col("_upto") - F.col("_c")).alias("_before"), "_lo", "_hi", "_d")
        after = store(state.where(~wide).unionByName(chosen), "quantile-ranks")
        discard(state)
        state = after
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*own, "_r").orderBy("_v"))
    at = held(state).withColumn("_upto", upto).where((F.col("_r") < F.col("_upto")) & (F.col("_r") >= F.col("_upto") - F.col("_c")))
    found = at.groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at"))
    named_found = within(found)
    both = sizes.join(named_found, same(sizes, named_found)) if own else sizes.crossJoin(found)

    def interpolated(q: float):
        place = F.lit(float(q)) * (F.col("_n") - 1)
        low, high = F.try_element_at("_at", rank(q, False)), F.try_element_at("_at", rank(q, True))
        return F.when(rank(q, False) == rank(q, True), low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    done = within(store(both.select(*own, "_n", F.array(*map(interpolated, qs)).alias("_q")), "quantiles"))
    discard(counted, state)
    groups = named.groupBy(*own).count() if own else named.limit(0).groupBy().count()
    out = groups.join(done, same(groups, done), "left") if own else groups.crossJoin(done)
    return out.select(*[F.col(o).alias(k) for k, o in zip(keys, own, strict=True)], F.coalesce("_n", F.lit(0)).cast("long").alias("n"), F.coalesce("_q", F.array(*[F.lit(None).cast("double")] * len(qs))).alias("q"))


def sliding_ranks(day: np.ndarray, value: np.ndarray, q: float, window: int, year: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """For each day 1..year with samples within ``window`` days (around the year): the day, and the sample of rank round-half-even(q (n - 1)).

    NaN samples are missing: they count and sort last, so a result may be NaN. The samples are sorted once; as the
    window moves, entries are marked and unmarked, and marks are counted by blocks, so the k-th is found by
    two short sums. Memory is a few numbers for each sample, whatever the window.
    """
    here = np.flatnonzero(~np.isnan(value))
    order = here[np.argsort(value[here], kind="stable")]
    ordered = value[order]
    by_day = np.argsort(day[order], kind="stable")
    edge = np.searchsorted(day[order][by_day], np.arange(1, year + 2))
    all_of = np.bincount(day, minlength=year + 1)[1:]
    marked, blocks = np.zeros(len(order), bool), np.zeros(len(order) // block + 1, np.int64)
    total = 0

    def move(d: int, on: bool) -> None:
        nonlocal total
        k = (d - 1) % year
        own = by_day[edge[k] : edge[k + 1]]
        marked[own] = on
        np.add.at(blocks, own // block, 1 if on else -1)
        total += int(all_of[k]) if on else -int(all_of[k])

    whole = 2 * window + 1 >= year
    for d in range(1, year + 1) if whole else range(1 - window, 1 + window):
        move(d, True)
    days, found = [], []
    for d in range(1, year + 1):
        if not whole:
            move(d + window, True)
            if d > 1:
                move(d - 1 - window, False)
        if total:
            k, sums = int(np.rint(q * (total - 1))), np.cumsum(blocks)
            days.append(d)
            if k >= sums[-1]:
                found.append(np.nan)
                continue
            b = int(np.searchsorted(sums, k, "right"))
            rest = k - (int(sums[b - 1]) if b else 0)
            found.append(ordered[b * block + np.flatnonzero(marked[b * block : (b + 1) * block])[rest]])
    return np.array(days, np.int32), np.array(found, float)
