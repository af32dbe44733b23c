"""Terciles, categories and raw anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.selection import exact_quantiles


def describe_field(df: DataFrame, keys) -> DataFrame:
    """Finite count and share, min, max, mean, population std, p10, p50 and p90 (linear) of the finite values.

    A group may be of any size: its quantiles are selected, not sorted.
    """
    finite = F.when(F.abs("value") < F.lit(float("inf")), F.col("value"))
    q = exact_quantiles(df, keys, (0.1, 0.5, 0.9)).withColumnsRenamed({k: f"_{k}" for k in keys})
    own = df.groupBy(*keys).agg(
        F.count(finite).alias("finite"), (F.count(finite) / F.count("*")).alias("finite_share"), F.min(finite).alias("min"), F.max(finite).alias("max"),
        F.avg(finite).alias("mean"), F.stddev_pop(finite).alias("std"),
    )
    out = own.join(q, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return out.withColumns({"p10": F.col("q")[0], "p50": F.col("q")[1], "p90": F.col("q")[2]}).drop("q", "n", *[f"_{k}" for k in keys])


def terciles(df: DataFrame, keys, low: float = 0.33, high: float = 0.66) -> DataFrame:
    """Linearly interpolated quantiles over the other dimensions: keys, t33, t66; groups may be of any size."""
    return exact_quantiles(df, keys, (low, high)).select(*keys, F.col("q")[0].alias("t33"), F.col("q")[1].alias("t66"))


def latest(df: DataFrame, keys, time: str = "init_date") -> DataFrame:
    """The value at the last time of each key."""
    return df.groupBy(*keys).agg(F.max_by("value", time).alias("value"))


def tercile_category(df: DataFrame, bounds: DataFrame, keys) -> DataFrame:
    """Keys, category (bn below t33, an from t66 on, nn the rest), percent (100 or 0); missing values give nulls."""
    v = F.col("value")
    bn, an = v < F.col("t33"), v >= F.col("t66")
    each = [("bn", bn), ("nn", ~bn & ~an), ("an", an)]
    rows = F.inline(F.array(*[F.struct(F.lit(n).alias("category"), (c.cast("int") * 100.0).alias("percent")) for n, c in each]))
    return df.join(bounds, list(keys)).select(*keys, rows)


def raw_anomaly(forecast: DataFrame, hindcast: DataFrame, keys, time: str = "init_date") -> DataFrame:
    """The forecast's last slice minus the hindcast's mean over time."""
    normal = hindcast.groupBy(*keys).agg(F.avg("value").alias("_normal"))
    return latest(forecast, keys, time).join(normal, list(keys)).select(*keys, (F.col("value") - F.col("_normal")).alias("value"))


def standardize_prob(df: DataFrame) -> DataFrame:
    """Categories renamed bn, nn, an; fractions (no value above 1.01 anywhere) become percent."""
    c = F.lower(F.col("category").cast("string"))
    name = F.when(c.isin("bn", "0", "below", "below_normal"), "bn").when(c.isin("nn", "1", "near", "near_normal", "normal"), "nn").when(c.isin("an", "2", "above", "above_normal"), "an").otherwise(c)
    most = df.agg(F.max("value").alias("_most"))  # one row
    scale = F.when(F.col("_most") <= 1.01, F.lit(100.0)).otherwise(F.lit(1.0))
    return df.crossJoin(F.broadcast(most)).withColumns({"category": name, "value": F.col("value") * scale}).drop("_most")
