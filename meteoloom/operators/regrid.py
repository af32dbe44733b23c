"""Grids: subsampling, bilinear interpolation, nearest cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def subsample_grid(df: DataFrame, step: int = 1, native: float = 0.5, expected: tuple[int, int] | None = None) -> DataFrame:
    """Exact subsample of a regular grid: longitudes snapped and taken modulo 360, only whole
    multiples of ``step`` kept. ``expected`` (lats, lons) raises if the grid has other sizes."""
    n = round(1 / native)
    lon = F.pmod(F.bround(F.col("lon") * n) / n, F.lit(360.0))
    lat = F.bround(F.col("lat") * n) / n
    out = df.withColumns({"lat": lat, "lon": lon}).where((F.pmod(F.col("lat"), F.lit(float(step))) == 0) & (F.pmod(F.col("lon"), F.lit(float(step))) == 0))
    if expected:
        got = out.agg(F.countDistinct("lat"), F.countDistinct("lon")).first()
        if tuple(got) != tuple(expected):
            raise ValueError(f"the grid has {tuple(got)} latitudes and longitudes, not {tuple(expected)}")
    return out


def brackets(df: DataFrame, targets: DataFrame, col: str, step: float | None = None) -> DataFrame:
    """For each target label of ``col`` its neighbours on the source's axis, regular or not: _to, _at, _w (a row for each neighbour).

    Labels of both are merged in order, so the neighbours come from one window over them. A target on a label, but for rounding, has that
    one neighbour with weight 1; one outside the axis has none. With ``step`` neighbours further apart don't count.
    """
    own = df.select(F.col(col).cast("double").alias("_x")).where("_x is not null").distinct().select("_x", F.col("_x").alias("_own"), F.lit(None).cast("double").alias("_to"))
    ask = targets.select(F.col(col).cast("double").alias("_to")).where("_to is not null").distinct()
    w = Window.orderBy("_x")  # the labels of one axis
    below = F.last("_own", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    above = F.first("_own", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    near = own.unionByName(ask.select(F.col("_to").alias("_x"), F.lit(None).cast("double").alias("_own"), "_to")).withColumns({"_below": below, "_above": above}).where("_to is not null")
    gap = F.coalesce(F.col("_above") - F.col("_below"), F.greatest(F.lit(1.0), F.abs("_to")))
    close = lambda c: F.abs(F.col(c) - F.col("_to")) <= 1e-9 * F.when(gap > 0, gap).otherwise(F.lit(1.0))
    one = lambda at, weight: F.struct(at.alias("_at"), weight.cast("double").alias("_w"))
    share = (F.col("_to") - F.col("_below")) / gap
    both = F.array(one(F.col("_below"), 1 - share), one(F.col("_above"), share))
    fits = F.col("_below").isNotNull() & F.col("_above").isNotNull() & (F.lit(True) if step is None else gap <= step * (1 + 1e-6))
    picked = F.when(close("_below"), F.array(one(F.col("_below"), F.lit(1)))).when(close("_above"), F.array(one(F.col("_above"), F.lit(1)))).when(fits, both)
    return near.select("_to", F.inline(picked))


def bilinear(df: DataFrame, grid: DataFrame, step_lat: float | None = None, step_lon: float | None = None) -> DataFrame:
    """Values at ``grid`` (lat, lon) from a source grid whose axes may have any labels.

    Each target names its up to four neighbours with their weights, which meet the source by an equi-join on its
    labels. A target without all neighbours (outside the hull, or next to a missing value) is missing.
    """
    keys = [c for c in df.columns if c not in ("lat", "lon", "value")]
    small = _small(grid)
    g = grid.select(F.col("lat").cast("double").alias("_lat"), F.col("lon").cast("double").alias("_lon"))
    for col, step in (("lat", step_lat), ("lon", step_lon)):
        sides = brackets(df, grid, col, step).select(F.col("_to").alias(f"_{col}"), F.col("_at").alias(f"_at_{col}"), F.col("_w").alias(f"_w_{col}"))
        g = g.join(sides, f"_{col}")
    want = g.select("_lat", "_lon", "_at_lat", "_at_lon", (F.col("_w_lat") * F.col("_w_lon")).alias("_w"))
    named = df.withColumns({"_at_lat": F.col("lat").cast("double"), "_at_lon": F.col("lon").cast("double")}).drop("lat", "lon")
    near = named.join(F.broadcast(want) if small else want, ["_at_lat", "_at_lon"])
    out = near.groupBy(*keys, F.col("_lat").alias("lat"), F.col("_lon").alias("lon")).agg(F.sum(F.col("_w") * F.col("value")).alias("_v"), F.sum(F.when(F.col("value").isNotNull(), F.col("_w"))).alias("_sum"))
    targets = grid.select("lat", "lon")
    full = df.select(*keys).distinct().crossJoin(F.broadcast(targets) if small else targets)
    return full.join(out, [*keys, "lat", "lon"], "left").select(*keys, "lat", "lon", F.when(F.abs(F.col("_sum") - 1) < 1e-9, F.col("_v")).alias("value"))


def _small(grid: DataFrame, most: int = 1_000_000) -> bool:
    return grid.limit(most + 1).count() <= most


def nearest_label(axis: DataFrame, targets: DataFrame, col: str, grids=()) -> DataFrame:
    """For each target label of ``col`` the nearest label of the axis, however far; ties to the greater.

    ``axis``: grids, col; ``targets``: col. Returns grids, col (of the axis) and ``_to`` (the target).
    Both are merged in order, so that the labels below and above come from one window each.
    """
    names = axis.select(*grids).distinct() if grids else axis.sparkSession.range(1).select()
    own = axis.select(*grids, F.col(col).alias("_x"), F.col(col).alias("_own"), F.lit(None).cast("double").alias("_to")).distinct()
    ask = F.broadcast(targets.select(F.col(col).cast("double").alias("_to")).distinct())  # the labels of one axis
    asked = names.crossJoin(ask).select(*grids, F.col("_to").alias("_x"), F.lit(None).cast("double").alias("_own"), "_to")
    w = Window.partitionBy(*(grids or [F.lit(0)])).orderBy("_x")
    below = F.last("_own", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    above = F.first("_own", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    both = own.unionByName(asked).withColumns({"_below": below, "_above": above}).where("_to is not null")
    up = F.col("_below").isNull() | (F.col("_above") - F.col("_to") <= F.col("_to") - F.col("_below"))
    return both.select(*grids, F.when(up, F.col("_above")).otherwise(F.col("_below")).alias(col), "_to")


def nearest_cell(df: DataFrame, grid: DataFrame, grids=()) -> DataFrame:
    """For each target cell the value of the source cell at the nearest latitude and longitude.

    ``grids`` names the columns whose values have grids of their own. Latitude and longitude are
    looked up one after the other, so the source meets two lists of labels and isn't shuffled. A
    target far outside the source takes its border; a label between two takes the greater one.
    """
    keys = [c for c in df.columns if c not in ("lat", "lon", "value")]
    lat, lon = (nearest_label(df, grid, c, grids).select(*grids, c, F.col("_to").alias(f"_{c}")) for c in ("lat", "lon"))
    targets = grid.select(F.col("lat").cast("double").alias("_lat"), F.col("lon").cast("double").alias("_lon"))
    # Two joins on labels would pair every latitude with every longitude; the list of cells is as long as the grid.
    cells = targets.join(F.broadcast(lat), "_lat").join(F.broadcast(lon), ["_lon", *grids])
    out = df.join(F.broadcast(cells) if _small(grid) else cells, [*grids, "lat", "lon"])
    return out.select(*keys, F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), "value")


def regular_axis(spark, n: int, first: float, last: float) -> DataFrame:
    """Labels of an axis that has none: n even steps from first to last."""
    return spark.range(n).select(F.col("id").cast("int").alias("ix"), (F.lit(first) + F.col("id") * ((last - first) / max(1, n - 1))).alias("label"))


def grid_rank(df: DataFrame, col: str) -> DataFrame:
    """Index from 0 of each distinct coordinate in ascending order."""
    return df.select(col).distinct().withColumn("ix", (F.row_number().over(Window.orderBy(col)) - 1).cast("int"))
