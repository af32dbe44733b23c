"""Catalogs of files and runs: parsing, selection, worklists, names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bitsets
from ..functions.calendar import parse_date_token
from ..functions.ranking import global_rank


def list_files(spark, root: str, pattern: str = "*") -> DataFrame:
    """Paths and sizes under a folder, by Spark's own file source (contents aren't read)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", F.col("length").alias("bytes"))


def parse_catalog(paths: DataFrame) -> DataFrame:
    """Var, group, model (GROUP-MODEL), kind and init_date from a path; an invalid date is null.

    Names look like .../{kind}/{var}/{var}_{GROUP}-{MODEL}_{YYYYMMDD}.daily.nc.
    """
    return paths.withColumns(path_fields(F.col("path")))


def path_fields(path) -> dict:
    """Var, group, model, kind and init_date as expressions of a path."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    pattern = r"^([^_/]+)_([^-_/]+)-(.+?)_(\d{8})(?:[^0-9].*)?$"
    part = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))
    kind = F.nullif(F.regexp_extract(path, r"/(forecast|hindcast)/", 1), F.lit(""))
    return {"var": part(1), "group": part(2), "model": F.when(part(2).isNotNull(), F.concat(part(2), F.lit("-"), part(3))), "kind": kind, "init_date": F.try_to_date(part(4), "yyyyMMdd")}


def newest_init(catalog: DataFrame, fcst: str, lo: int = -7, hi: int = -1, candidates: DataFrame | None = None) -> DataFrame:
    """Newest start in [fcst + lo, fcst + hi] for each (model, var); ties to the earlier candidate, then path.

    ``candidates``: model, name, cand_ix; the catalog's model is then a candidate's name.
    """
    day = F.lit(fcst).cast("date")
    df = catalog.where(F.col("init_date").between(F.date_add(day, lo), F.date_add(day, hi)))
    if candidates is not None:
        df = df.withColumnRenamed("model", "name").join(F.broadcast(candidates), "name")
    else:
        df = df.withColumns({"name": F.col("model"), "cand_ix": F.lit(0)})
    w = Window.partitionBy("model", "var").orderBy(F.col("init_date").desc(), "cand_ix", "path")
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("model", "var", "name", "init_date", "path")


def lookback_dates(spark, fcst: str, days: int) -> DataFrame:
    """The last ``days`` (1 at least) dates up to fcst, newest first by ``rank``."""
    back = F.explode(F.sequence(F.lit(0), F.lit(max(1, days) - 1)))
    return spark.range(1).select(back.alias("rank")).select("rank", F.date_sub(F.lit(fcst).cast("date"), F.col("rank")).alias("day"))


def newest_in_lookback(catalog: DataFrame, fcst: str, days: int) -> DataFrame:
    """Newest start in the ``days`` dates that end at fcst, for each (model, var)."""
    return newest_init(catalog, fcst, -(max(1, days) - 1), 0)


def filter_listing(listing: DataFrame, var: str, dates: DataFrame, suffixes=(".nc", ".nc4", ".grb", ".grb2", ".tar")) -> DataFrame:
    """Entries (name, url) with a data suffix, the variable as a token of its own and a date of
    ``dates`` (day) in the name or else the url; newest first, then name descending (``rank``)."""
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.lower("name").endswith(s)
    token = F.col("name").rlike(rf"(?i)(^|[^a-z0-9]){var}([^a-z0-9]|$)")
    day = F.coalesce(parse_date_token(F.col("name")), parse_date_token(F.col("url")))
    got = listing.where(ends & token).withColumn("day", day).join(F.broadcast(dates.select("day")), "day", "left_semi")
    return global_rank(got, [F.col("day").desc(), F.col("name").desc()], "rank")


def plan_fetch(wanted: DataFrame, offered: DataFrame, held: DataFrame, key: str = "day") -> DataFrame:
    """Wanted and offered but not held."""
    return wanted.select(key).distinct().join(offered, key, "left_semi").join(held, key, "left_anti")


def sentinel_dates(listing: DataFrame, member: int = 1) -> DataFrame:
    """Distinct dates for which the sentinel member's file exists."""
    return listing.where(F.col("member") == member).select("init_date").distinct()


def members_by_init(listing: DataFrame, pattern: str = r"ens(\d+)") -> DataFrame:
    """Members of each start in numeric order."""
    m = F.try_to_number(F.nullif(F.regexp_extract("name", pattern, 1), F.lit("")), F.lit("999999999")).cast("int")
    return listing.withColumn("_m", m).groupBy("init_date").agg(F.array_sort(F.collect_set("_m")).alias("members"))


def complete_members(catalog: DataFrame, n_vars: int | None = None) -> DataFrame:
    """(model, init_date, member) that every variable of the model's start has."""
    n = catalog.groupBy("model", "init_date").agg(F.countDistinct("var").alias("_all")) if n_vars is None else None
    got = catalog.groupBy("model", "init_date", "member").agg(F.countDistinct("var").alias("_n"))
    if n is None:
        return got.where(F.col("_n") == n_vars).drop("_n")
    return got.join(n, ["model", "init_date"]).where("_n = _all").drop("_n", "_all")


def members_to_fetch(listed: DataFrame, complete: DataFrame) -> DataFrame:
    """Listed members that aren't complete."""
    return listed.join(complete, ["model", "init_date", "member"], "left_anti")


def mirror_diff(local: DataFrame, remote: DataFrame, since: str | None = None) -> DataFrame:
    """Local files that the mirror lacks, from a start date on if given. Columns of ``local``."""
    df = local if since is None else local.where(F.col("init_date") >= F.lit(since).cast("date"))
    return df.join(remote.select("path").distinct(), "path", "left_anti")


def mirror_counts(diff: DataFrame) -> DataFrame:
    """Missing files for each model and variable."""
    return diff.groupBy("model", "var").agg(F.count("*").alias("n"))


def start_words(catalog: DataFrame, keys=("model", "var")) -> DataFrame:
    """The starts of each (model, var) as words of 64 days (``functions/bitsets.py``), counted from 1970-01-01."""
    return bitsets.words(catalog, keys, F.unix_date("init_date"))


def missing_starts(local: DataFrame, remote: DataFrame, keys=("model", "var")) -> DataFrame:
    """S13 at archive size: starts that the mirror's words lack, as words. Both sides: ``start_words``.

    Files are told apart by (model, var, start), not by path: what is shuffled is a row for each model, variable and 64 days.
    """
    return bitsets.minus(local, remote, keys)


def starts_of(words: DataFrame, keys=("model", "var")) -> DataFrame:
    """keys, init_date of ``start_words``."""
    return bitsets.numbers(words, keys).select(*keys, F.date_from_unix_date(F.col("number").cast("int")).alias("init_date"))


def complete_member_words(catalog: DataFrame, n_vars: int | None = None) -> DataFrame:
    """Members that every variable of a (model, start) has, or ``n_vars`` of them, as words: the AND of the variables' words."""
    own = bitsets.words(catalog.where("var IS NOT NULL"), ["model", "init_date", "var"], F.col("member"))
    held = own.groupBy("model", "init_date", "word").agg(F.bit_and("bits").alias("bits"), F.count("*").alias("_n"))
    if n_vars is None:
        wanted = catalog.groupBy("model", "init_date").agg(F.countDistinct("var").alias("_all"))
        held = held.join(wanted, ["model", "init_date"])
    enough = F.col("_n") == (F.col("_all") if n_vars is None else F.lit(n_vars))
    return held.where(enough & (F.col("bits") != 0)).select("model", "init_date", "word", "bits")


def member_words_to_fetch(listed: DataFrame, complete: DataFrame) -> DataFrame:
    """Model, init_date, member: the listed members (rows) that the complete ones (words) lack."""
    keys = ["model", "init_date"]
    lack = bitsets.minus(bitsets.words(listed, keys, F.col("member")), complete, keys)
    return bitsets.numbers(lack, keys).select(*keys, F.col("number").cast("int").alias("member"))


def newest_of_words(words: DataFrame, fcst: str, days: int, keys=("model", "var")) -> DataFrame:
    """Keys, init_date: the newest start in the ``days`` dates (one at least) that end at fcst, by ``start_words``."""
    last = (date.fromisoformat(fcst) - date(1970, 1, 1)).days
    near = bitsets.within(words, last - max(1, days) + 1, last)
    return bitsets.greatest_number(near, keys).select(*keys, F.date_from_unix_date(F.col("number").cast("int")).alias("init_date"))


def resend_jobs(manifest: DataFrame, root: str, allowed: DataFrame, local: DataFrame) -> DataFrame:
    """Distinct paths with a status: send, or the first reason to skip of tmp, outside_root,
    not_mirrored, missing_locally. ``allowed``: model, var; ``local``: path."""
    d = parse_catalog(manifest.select("path").dropDuplicates(["path"]))
    d = d.join(allowed.select("model", "var").distinct().withColumn("_ok", F.lit(True)), ["model", "var"], "left")
    d = d.join(local.select("path").distinct().withColumn("_here", F.lit(True)), "path", "left")
    status = F.when(F.col("path").rlike(r"\.tmp|/tmp[./]|~$"), "tmp").when(~F.col("path").startswith(root.rstrip("/") + "/"), "outside_root").when(F.col("_ok").isNull(), "not_mirrored").when(F.col("_here").isNull(), "missing_locally").otherwise("send")
    return d.select("path", "model", "var", status.alias("status"))


def chunk(df: DataFrame, n: int, order="path", keys=()) -> DataFrame:
    """Batches of ``n``: batch (from 1) and batches (their number); within keys if there are any."""
    if keys:
        ranked = df.withColumn("batch", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
        out = ranked.withColumn("batches", F.count("*").over(Window.partitionBy(*keys)))
    else:
        ranked = global_rank(df, [F.col(order)], "batch")
        out = ranked.crossJoin(F.broadcast(ranked.agg(F.count("*").alias("batches"))))  # one row
    return out.withColumns({"batch": (F.floor((F.col("batch") - 1) / n) + 1).cast("int"), "batches": F.ceil(F.col("batches") / n).cast("int")})


def limit_per_model(df: DataFrame, n: int) -> DataFrame:
    """The first n files of each model by the variable's configured place (var_ix), then name."""
    w = Window.partitionBy("model").orderBy("var_ix", "name")
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def latest_starts(archive: DataFrame, n: int = 4) -> DataFrame:
    """The n most recent starts of each model (model, init_date)."""
    starts = archive.select("model", "init_date").distinct()
    w = Window.partitionBy("model").orderBy(F.col("init_date").desc())
    return starts.withColumn("_n", F.dense_rank().over(w)).where(F.col("_n") <= n).drop("_n")


def archive_diff(landing: DataFrame, archive: DataFrame, key=("model", "var", "init_date")) -> DataFrame:
    """What the landing catalog has and the archive lacks."""
    return landing.select(*key).distinct().join(archive.select(*key).distinct(), list(key), "left_anti")


def parity(primary: DataFrame, shadow: DataFrame, key=("model", "var", "init_date"), schema: str = "schema") -> DataFrame:
    """All keys of both catalogs: presence (both, primary_only, shadow_only) and whether the
    schemas agree (null unless both have one)."""
    a = primary.groupBy(*key).agg(F.min(schema).alias("_a")).withColumn("_in_a", F.lit(True))
    b = shadow.groupBy(*key).agg(F.min(schema).alias("_b")).withColumn("_in_b", F.lit(True))
    out = a.join(b, list(key), "full")
    presence = F.when(F.col("_in_b").isNull(), "primary_only").when(F.col("_in_a").isNull(), "shadow_only").otherwise("both")
    return out.select(*key, presence.alias("presence"), F.when(presence == "both", F.col("_a") == F.col("_b")).alias("schema_ok"))


# ------------------------------------------------------------------ names and configuration as tables


def resolve_models(models: DataFrame, variables: DataFrame, overrides: DataFrame, skip: DataFrame) -> DataFrame:
    """F8: (label, var) to archive. A skip list drops models; an override by label, else by name,
    else the model's own list names the variables; those that ``variables`` (label, var) doesn't
    know drop out, and with them models left without any.

    ``models``: label, name, vars (array); ``overrides``: key, vars; ``skip``: label.
    """
    m = models.join(skip, "label", "left_anti")
    o1 = overrides.select(F.col("key").alias("label"), F.col("vars").alias("_v1"))
    o2 = overrides.select(F.col("key").alias("name"), F.col("vars").alias("_v2"))
    m = m.join(o1, "label", "left").join(o2, "name", "left")
    want = m.select("label", F.explode(F.coalesce("_v1", "_v2", "vars")).alias("var")).distinct()
    return want.join(variables, ["label", "var"], "left_semi")


def unknown_variables(wanted: DataFrame, variables: DataFrame) -> DataFrame:
    """F8: wanted (label, var) that the source doesn't know, for a warning."""
    return wanted.join(variables, ["label", "var"], "left_anti")


def model_names(models: DataFrame, names: DataFrame) -> DataFrame:
    """local name of each model: the map's entry for GROUP-MODEL, else for MODEL, else itself;
    and the distinct candidates [mapped, served] in order. ``models``: group, name; ``names``: key, local."""
    served = F.concat_ws("-", "group", "name")
    m = models.withColumn("model", served)
    a, b = (names.select(F.col("key").alias(k), F.col("local").alias(v)) for k, v in (("model", "_a"), ("name", "_b")))
    m = m.join(a, "model", "left").join(b, "name", "left")
    local = F.coalesce("_a", "_b", "name")
    mapped = F.when(F.coalesce("_a", "_b").isNotNull(), F.concat_ws("-", F.col("group"), local)).otherwise(F.col("model"))
    return m.select("model", local.alias("local"), F.array_distinct(F.array(mapped, F.col("model"))).alias("candidates"))


def model_order(available: DataFrame, preferred: list[str], configured: list[str], mme: str = "SUBC-MME") -> DataFrame:
    """rank of the available models: preferred ones first, then configured, then the rest by name,
    the multi-model mean last. A listed name also means its 5-daily variant."""
    plain = F.regexp_replace("model", "_5daily$", "")
    at = lambda names: F.array_position(F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>"), plain)
    p, c = at(preferred), at(configured)
    w = Window.orderBy(F.when(F.col("model") == mme, 3).when(p > 0, 0).when(c > 0, 1).otherwise(2), F.when(p > 0, p).otherwise(c), "model")
    return available.select("model").distinct().withColumn("rank", F.row_number().over(w))


def predictor_specs(specs: DataFrame, leads: DataFrame) -> DataFrame:
    """names of each predictor's models from the first list that is set (explicit, cli, group,
    models, default), with every lead that a file is expected for."""
    names = F.coalesce("explicit", "cli", "group", "models", "default")
    return specs.select("predictor", F.explode(names).alias("model")).distinct().crossJoin(F.broadcast(leads))


def route_sources(models: DataFrame, default: str, overrides: DataFrame, direct: DataFrame) -> DataFrame:
    """the provider of each model: its override, else the default; 'direct_x' is x, and plain
    'direct' is looked up by model. ``overrides``: model, source; ``direct``: model, provider."""
    m = models.join(overrides, "model", "left").join(direct, "model", "left")
    source = F.coalesce(F.col("source"), F.lit(default))
    provider = F.when(source == "direct", F.col("provider")).when(source.startswith("direct_"), F.substring(source, 8, 100)).otherwise(source)
    return m.select("model", source.alias("source"), provider.alias("provider"))


def candidates_table(names: DataFrame) -> DataFrame:
    """model, name, cand_ix rows from ``model_names``."""
    return names.select("model", F.posexplode("candidates").alias("cand_ix", "name"))
