"""Bringing provider data to the canonical cube."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ("model", "var", "init_date")
#: Names that stand for each role of a dimension.
ALIASES = {
    "time": ("time", "valid_time"),
    "lat": ("lat", "latitude", "y"),
    "lon": ("lon", "longitude", "x"),
    "member": ("member", "m", "ensemble", "number"),
    "init": ("init", "s", "start", "forecast_reference_time"),
    "level": ("level", "p", "plev", "pressure"),
    "lead": ("lead", "l", "step"),
}
#: Provider variable names.
VARIABLES = {"PRECTOTCORR": "pr", "T2M": "tas", "TS": "ts", "OLR": "rlut", "U": "ua", "V": "va", "H": "zg", "air_temperature": "tas"}


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on keys that may be null; the keys come from the left side only."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    out = left.join(named, on, how)
    return out.drop(*[f"_right_{k}" for k in keys])


def snap_grid(df: DataFrame, digits: int = 6, *cols: str) -> DataFrame:
    """Round coordinates (half to even); 0 digits snaps to whole degrees. -0.0 becomes 0.0."""
    return df.withColumns({c: F.bround(c, digits) + F.lit(0.0) for c in cols or ("lat", "lon")})


def merge_duplicate_cells(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows that agree in everything but the value become their mean."""
    keys = [c for c in df.columns if c != value]
    return df.groupBy(*keys).agg(F.avg(value).alias(value)).select(*df.columns)


def ensure_lon(df: DataFrame, convention: str = "0_360", col: str = "lon") -> DataFrame:
    """P3: '0_360' adds 360 to negative longitudes, 'negpos' takes 360 off those over 180."""
    x = F.col(col)
    if convention == "0_360":
        return df.withColumn(col, F.when(x < 0, x + 360).otherwise(x))
    if convention == "negpos":
        return df.withColumn(col, F.when(x > 180, x - 360).otherwise(x))
    raise ValueError(f"unknown longitude convention {convention!r}")


def canonical_columns(df: DataFrame, aliases=None) -> DataFrame:
    """P5: rename columns to their role, whatever their case; the first match of a role counts."""
    taken, names = set(df.columns), {}
    for role, options in (aliases or ALIASES).items():
        found = next((c for o in options for c in df.columns if c.lower() == o), None)
        if found and found != role and role not in taken:
            names[found] = role
    return df.withColumnsRenamed(names)


def unit_days(unit: Column) -> Column:
    """Days in one unit of a lead: hours, minutes and seconds by the start of the name, else days."""
    u = F.lower(F.coalesce(unit, F.lit("days")))
    return F.when(u.startswith("h"), F.lit(1 / 24)).when(u.startswith("min"), F.lit(1 / 1440)).when(u.startswith("sec"), F.lit(1 / 86400)).otherwise(F.lit(1.0))


def decode_lead(df: DataFrame, lead: str = "lead", unit: str = "units") -> DataFrame:
    """lead_days from lead and unit; valid_date is the start's day plus whole days of lead."""
    days = F.col(lead) * unit_days(F.col(unit))
    return df.withColumn("lead_days", days.cast("float")).withColumn("valid_date", F.date_add("init_date", F.floor(days).cast("int")))


def label_leads(df: DataFrame, first=None, default: float = 0.5) -> DataFrame:
    """lead_days = first label of the provider + position, over any raw stamps. ``first``: {provider: label}."""
    pairs = [F.lit(x) for kv in (first or {"GEFS": 1.5}).items() for x in kv]
    start = F.coalesce(F.create_map(*pairs)[F.col("provider")], F.lit(default))
    return df.withColumn("lead_days", (start + F.col("lead_ix")).cast("float"))


def lead_from_valid(df: DataFrame, valid: str = "valid_ts", init: str = "init_ts") -> DataFrame:
    """Lead in days between two timestamps."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return df.withColumn("lead_days", ((micros(valid) - micros(init)) / F.lit(86400e6)).cast("float"))


def cap_lead(df: DataFrame, most: float = 45) -> DataFrame:
    """Leads up to a label: 45 rows from labels 0.5, ..., 46 from whole ones."""
    return df.where(F.col("lead_days") <= most)


def select_level(df: DataFrame, dims: DataFrame) -> DataFrame:
    """P10: the level that (model, var) asks for; no level matches none. ``dims``: model, var, level (one row each)."""
    d = dims.select(F.col("model").alias("_m"), F.col("var").alias("_v"), F.col("level").alias("_l"))
    on = (F.col("model") == F.col("_m")) & (F.col("var") == F.col("_v")) & F.col("level").eqNullSafe(F.col("_l"))
    return df.join(d, on, "left_semi")


def fold_starts(df: DataFrame) -> DataFrame:
    """Sub-daily starts become members, numbered from 1 by start, then member."""
    members = df.select(*SERIES, "init_ts", "member").distinct()  # few rows for each start
    rank = F.dense_rank().over(Window.partitionBy(*SERIES).orderBy("init_ts", "member"))
    numbered = members.withColumn("_new", rank)
    return join_null_safe(df, numbered, [*SERIES, "init_ts", "member"]).withColumn("member", F.col("_new")).select(*df.columns)


def is_accumulated(units: Column) -> Column:
    """Precipitation units that aren't a rate: non-empty and without 's-1', '/s' or 's^-1'."""
    u = F.coalesce(units, F.lit(""))
    return (u != "") & ~(u.contains("s-1") | u.contains("/s") | u.contains("s^-1"))


def convert_units(df: DataFrame, rule: str, units: str = "units") -> DataFrame:
    """P12: 'rate' divides accumulated pr by 86400, 'daily' multiplies pr by 86400, 'hpa' divides psl by
    100, 'reader' multiplies by 86400 those variables of which no value reaches 1."""
    v = F.col("value")
    if rule == "rate":
        return df.withColumn("value", F.when(F.col("var").startswith("pr") & is_accumulated(F.col(units)), v / 86400).otherwise(v))
    if rule == "daily":
        return df.withColumn("value", F.when(F.col("var").startswith("pr"), v * 86400).otherwise(v))
    if rule == "hpa":
        return df.withColumn("value", F.when(F.col("var") == "psl", v / 100).otherwise(v))
    if rule == "reader":
        most = df.groupBy(F.col("var").alias("_v")).agg(F.max("value").alias("_most"))  # a row for each variable
        out = df.join(F.broadcast(most), F.col("var").eqNullSafe(F.col("_v")), "left")
        return out.withColumn("value", F.when(F.col("_most") < 1, v * 86400).otherwise(v)).select(*df.columns)
    raise ValueError(f"unknown rule {rule!r}")


def rename_vars(df: DataFrame, names=None, col: str = "var") -> DataFrame:
    """Provider variable names to ours; others stay."""
    pairs = [F.lit(x) for kv in (names or VARIABLES).items() for x in kv]
    return df.withColumn(col, F.coalesce(F.create_map(*pairs)[F.col(col)], F.col(col)))


def output_name(var: Column, level: Column) -> Column:
    """Var, or var_level where there is a level."""
    return F.concat_ws("_", var, level.cast("string"))


def product_tag(pct: Column, direction: Column) -> Column:
    """p95_above."""
    return F.concat(F.lit("p"), pct.cast("string"), F.lit("_"), direction)


def safe_tag(name: Column) -> Column:
    """Anything but letters, digits, dot and hyphen becomes one underscore."""
    return F.regexp_replace(name, r"[^A-Za-z0-9.\-]+", "_")


def legacy_model(model: Column, mme: str = "SUBC-MME") -> Column:
    """The model without its group; the multi-model mean is MME."""
    return F.when(model == mme, F.lit("MME")).otherwise(F.element_at(F.split(model, "-", 2), -1))


def lead_position(df: DataFrame, by: str = "lead_days", keys=SERIES) -> DataFrame:
    """lead_ix, the position from 0 of a lead among those of its series.

    Ranked on the distinct leads, so the window holds one row for each lead and not for each cell.
    """
    leads = df.select(*keys, by).distinct()
    ix = (F.dense_rank().over(Window.partitionBy(*keys).orderBy(by)) - 1).cast("int")
    ranked = leads.withColumn("_ix", ix)
    return join_null_safe(df.drop("lead_ix"), ranked, [*keys, by]).withColumnRenamed("_ix", "lead_ix")


def spine(df: DataFrame, keys, axis: DataFrame) -> DataFrame:
    """Every key of ``df`` with every row of ``axis`` (small), and the values where there are any."""
    full = df.select(*keys).distinct().crossJoin(F.broadcast(axis))
    return full.join(df, [*keys, *axis.columns], "left")


def fix_shape(df: DataFrame, n_lead: int = 45, n_member: int = 15, models=("GMAO-GEOS_V3",), kind: str = "forecast") -> DataFrame:
    """The first leads by position and members 1..n (padded missing), for forecasts of ``models`` only."""
    this = F.coalesce(F.col("model").isin(*models) & (F.col("kind") == kind), F.lit(False))
    own = df.where(this & (F.col("lead_ix") < n_lead))
    members = df.sparkSession.range(1, n_member + 1).select(F.col("id").cast("int").alias("member"))
    keys = [c for c in df.columns if c not in ("member", "value")]
    return spine(own, keys, members).select(*df.columns).unionByName(df.where(~this))


def start_spine(df: DataFrame, hours=(0, 6, 12, 18)) -> DataFrame:
    """Sub-daily starts reindexed to the given hours; missing ones are padded with nulls."""
    axis = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, hours))).alias("_h"))
    keys = [c for c in df.columns if c not in ("init_ts", "value")]
    full = df.select(*keys).distinct().crossJoin(F.broadcast(axis))
    full = full.withColumn("init_ts", F.timestamp_add("HOUR", F.col("_h"), F.col("init_date").cast("timestamp_ntz"))).drop("_h")
    return join_null_safe(full, df, [*keys, "init_ts"], "left").select(*df.columns)


def pad_union(df: DataFrame, axis: str, over=SERIES) -> DataFrame:
    """Every series gets the union of a dimension's labels (leads of all members, levels of all variables)."""
    group = [c for c in over if c in df.columns]
    labels = df.select(*group, axis).distinct()
    keys = [c for c in df.columns if c not in (axis, "value")]
    full = df.select(*keys).distinct().join(labels, group) if group else df.select(*keys).distinct().crossJoin(labels)
    return join_null_safe(full, df, [*keys, axis], "left").select(*df.columns)


def align_leads(df: DataFrame, ref: DataFrame) -> DataFrame:
    """Labels of the reference (lead_ix, lead_days) by position; positions that it lacks drop out."""
    r = ref.select(F.col("lead_ix").alias("_ix"), F.col("lead_days").alias("_days"))
    return df.join(F.broadcast(r), F.col("lead_ix") == F.col("_ix")).withColumn("lead_days", F.col("_days")).select(*df.columns)


def lead_drift(df: DataFrame, ref: DataFrame, tolerance: float = 1e-6, keys=("model", "var")) -> DataFrame:
    """Positions where labels differ from the reference by more than the tolerance."""
    own = df.select(*keys, "lead_ix", "lead_days").distinct()
    r = ref.select(F.col("lead_ix").alias("_ix"), F.col("lead_days").alias("reference"))
    return own.join(F.broadcast(r), F.col("lead_ix") == F.col("_ix")).where(F.abs(F.col("lead_days") - F.col("reference")) > tolerance).drop("_ix")


def stack(*frames: DataFrame) -> DataFrame:
    """Members, levels, starts or models in one cube; in long form padding is implicit."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


stack_models = stack


def widen_vars(df: DataFrame, variables=None, on_conflict: str = "first", order: str = "init_ts") -> DataFrame:
    """One column for each variable. Values that disagree: the earliest by ``order`` wins (on
    ties the least value), or 'error' raises. Without a column ``order`` the least value wins.
    """
    keys = [c for c in df.columns if c not in ("var", "value", *([order] if on_conflict == "first" else []))]
    pivot = df.groupBy(*keys).pivot("var", list(variables) if variables else None)
    if on_conflict == "first":
        rank = F.struct(*[c for c in (order, "value") if c in df.columns])
        return pivot.agg(F.min_by("value", F.when(F.col("value").isNotNull(), rank)))
    one = F.when(F.coalesce(F.min("value") == F.max("value"), F.lit(True)), F.max("value")).otherwise(F.raise_error(F.lit("values of one cell disagree")).cast("double"))
    return pivot.agg(one)
