"""Presence, policy and schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import newest_in_lookback, newest_of_words


def presence(expected: DataFrame, catalog: DataFrame, fcst: str, days: int) -> DataFrame:
    """V1: every expected (model, var) with its newest file in the lookback and whether there is one."""
    near = newest_in_lookback(catalog, fcst, days).select("model", "var", "init_date", "path")
    return expected.join(near, ["model", "var"], "left").withColumn("ok", F.col("path").isNotNull())


def presence_of_words(expected: DataFrame, words: DataFrame, fcst: str, days: int) -> DataFrame:
    """V1 by ``start_words`` of the catalog: every expected (model, var) with its newest start in the lookback and whether there is one."""
    near = newest_of_words(words, fcst, days)
    return expected.join(near, ["model", "var"], "left").withColumn("ok", F.col("init_date").isNotNull())


def enforce(report: DataFrame, policy: str = "warn") -> int:
    """V2: 1 if something is missing under 'fail_on_missing', else 0. One count reaches the driver."""
    return int(policy == "fail_on_missing" and report.where(~F.col("ok")).count() > 0)


def policy_codes(report: DataFrame, policies: DataFrame, keys=("model",)) -> DataFrame:
    """V2: the exit code of each key's policy (keys, policy): 1 if something is missing under 'fail_on_missing', else 0."""
    lacks = report.groupBy(*keys).agg(F.count_if(~F.col("ok")).alias("missing"))
    code = (F.col("policy") == "fail_on_missing") & (F.col("missing") > 0)
    return lacks.join(policies, list(keys)).withColumn("code", code.cast("int"))


def status_counts(df: DataFrame, status: str = "status", keys=()) -> DataFrame:
    """Rows of each status."""
    return df.groupBy(*keys, status).agg(F.count("*").alias("n"))


def has_variable(names: Column, var: Column) -> Column:
    """V3: the variable under its name, or as prefix, suffix or part of one, whatever the case."""
    v = F.lower(var)
    return F.exists(names, lambda n: F.contains(F.lower(n), v))


def schema_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """V3: model, var, compatible: both have exactly one size each of time, lat and lon, these are
    equal, and both hold the variable.

    Inputs: model, var, dims (map of canonical role to size), names (array of variable names).
    """
    core = ("time", "lat", "lon")
    x = a.select("model", "var", F.col("dims").alias("_da"), F.col("names").alias("_na"))
    y = b.select("model", "var", F.col("dims").alias("_db"), F.col("names").alias("_nb"))
    same = F.lit(True)
    for c in core:
        same = same & F.coalesce(F.col("_da")[c] == F.col("_db")[c], F.lit(False))
    return x.join(y, ["model", "var"]).select("model", "var", (same & has_variable(F.col("_na"), F.col("var")) & has_variable(F.col("_nb"), F.col("var"))).alias("compatible"))


def dims_map(shapes: DataFrame, aliases=None) -> DataFrame:
    """V3: path, dim, size rows to one map of canonical role to size for each path (P5)."""
    from .normalise import ALIASES

    role = F.lit(None).cast("string")
    for name, options in (aliases or ALIASES).items():
        role = F.when(F.lower("dim").isin(*options), name).otherwise(role)
    role = F.when(F.lower("dim") == "l", "time").otherwise(role)  # a lead axis is the time axis
    return shapes.withColumn("_role", role).where("_role is not null").groupBy("path").agg(F.map_from_entries(F.collect_set(F.struct("_role", "size"))).alias("dims"))


def parity_counts(report: DataFrame) -> DataFrame:
    """V4: one row with keys in both, one-sided ones, and schema ok / mismatch / unavailable."""
    n = lambda c: F.count_if(c)
    return report.agg(
        n(F.col("presence") == "both").alias("both"), n(F.col("presence") == "primary_only").alias("primary_only"), n(F.col("presence") == "shadow_only").alias("shadow_only"),
        n(F.col("schema_ok")).alias("schema_ok"), n(~F.col("schema_ok")).alias("schema_mismatch"), n(F.col("schema_ok").isNull()).alias("schema_unavailable"),
    )


def smoke_runs(inputs: DataFrame, forecasts: DataFrame, smoke: bool) -> DataFrame:
    """V5: a row for each run (``forecasts``: fcst_date) with its number of input rows (``inputs``:
    fcst_date); a run without any is marked in smoke mode, or fails the job without ``smoke``."""
    n = inputs.groupBy("fcst_date").agg(F.count("*").alias("inputs"))
    runs = forecasts.select("fcst_date").distinct().join(n, "fcst_date", "left").withColumn("inputs", F.coalesce("inputs", F.lit(0)))
    empty = F.col("inputs") == 0
    if not smoke:
        empty = F.when(empty, F.raise_error(F.concat(F.lit("no input for "), F.col("fcst_date").cast("string"))).cast("boolean")).otherwise(F.lit(False))
    return runs.withColumn("smoke_mode", empty)


def smoke_manifest(df: DataFrame, fcst: str, smoke: bool) -> DataFrame:
    """V5: one row for the run; without any input it is marked in smoke mode and an error otherwise."""
    empty = df.isEmpty()
    if empty and not smoke:
        raise ValueError(f"no input for {fcst}")
    return df.sparkSession.range(1).select(F.lit(fcst).cast("date").alias("fcst_date"), F.lit(empty).alias("smoke_mode"))
