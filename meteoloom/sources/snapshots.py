"""A cube archive whose versions are committed as a whole.

Under the root lie ``data`` (files that never change, in a folder for each commit; a file holds many
partitions, each a (model, var, init_date), sorted by them), ``lists`` (the live partitions of each version's files, a Parquet
table with a row for each) and ``log`` (``v1``, ``v2``, ... each names the list of its version). How many files
there are thus follows the bytes, not the partitions, and a partition is dropped from a file by dropping its row. A commit writes its files and its list
first and then takes the name of the next version, which only one of several writers gets. Readers
see the version that they opened, whatever is written, and a writer that dies leaves nothing but
files that no version names.

The list also holds the slots of each partition with their counts and fields, so that a sync is planned
without reading the archive, and lead labels that replace the stored ones when the file is read, so that
relabelling rewrites no cell. ``of`` is the number of partitions that a file was written with: a file of which
all are wanted is read as it is, any other is joined with its rows of the list.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .working import delete, discard, store

PARTS = ("model", "var", "init_date")
SLOT = (*PARTS, "init_ts")
FILES = (
    "path string, model string, var string, init_date date, "
    "slots array<struct<init_ts: timestamp_ntz, cells: bigint, filled: bigint, fields: array<struct<member: int, lead_ix: int>>>>, "
    "labels array<struct<kind: string, leads: array<float>>>, of bigint"
)
_NAMES = ("path", *PARTS, "slots", "labels", "of")
#: Rows of a file at most; a partition may go on in the next one.
FILE_ROWS = 1 << 26
_LABELS = "array<struct<kind: string, leads: array<float>>>"


class Conflict(RuntimeError):
    """Another writer committed the version first; plan again from the version that is now the newest."""


def slot_counts(cube: DataFrame, *more: str) -> DataFrame:
    """Rows (cells), values (filled) and fields of each slot: the (member, lead_ix) that it has rows of.

    A cube without members has fields with a null member.
    """
    return _sum_fields(_field_counts(cube, *more), *more)


def _field_counts(cube: DataFrame, *more: str) -> DataFrame:
    member = F.col("member") if "member" in cube.columns else F.lit(None)
    field = F.struct(member.cast("int").alias("member"), F.col("lead_ix").cast("int").alias("lead_ix"))
    return cube.groupBy(*more, *SLOT, field.alias("_field")).agg(F.count("*").alias("_cells"), F.count("value").alias("_filled"))


def _sum_fields(each: DataFrame, *more: str) -> DataFrame:
    return each.groupBy(*more, *SLOT).agg(F.sum("_cells").alias("cells"), F.sum("_filled").alias("filled"), F.array_sort(F.collect_list("_field")).alias("fields"))


class Archive:
    """An archive in any file system that Spark reaches.

    The name of a version is claimed by a hard link (local) or by a rename that doesn't overwrite,
    which is atomic in HDFS and the like; on an object store it needs a committer that creates files
    on condition.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/log"))

    # -------------------------------------------------------------- reading

    def version(self) -> int:
        """The newest version; 0 before the first."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/log"))]
        return max([0, *(int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit())])

    def _list(self, version: int) -> str:
        stream = self._fs.open(self._path(f"{self.root}/log/v{version}"))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def files(self, version: int | None = None) -> DataFrame:
        """Live partitions of a version's files: path, partition values, slots, labels (null: as stored), of."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(f"{self.root}/lists/{self._list(version)}")

    def slots(self, version: int | None = None) -> DataFrame:
        """SLOT, cells, filled, fields of a version, from its list alone."""
        each = self.files(version).select(*PARTS, F.inline("slots"))
        fields = F.array_sort(F.array_distinct(F.flatten(F.collect_list("fields"))))
        return each.groupBy(*SLOT).agg(F.sum("cells").alias("cells"), F.sum("filled").alias("filled"), fields.alias("fields"))

    def read(self, schema, version: int | None = None, where: Column | None = None) -> DataFrame:
        """Cells of a version. ``where`` is a condition on model, var and init_date; files that it leaves out aren't even listed."""
        live = self.files(version)
        return self.read_files(live, schema) if where is None else self.read_files(live.where(where), schema, where)

    def read_files(self, files: DataFrame, schema, where: Column | None = None) -> DataFrame:
        """Cells of some of the live partitions (path, PARTS, labels, of). The files' names are listed on the driver, as Spark does for any table.

        A file of which all partitions are wanted as stored is read as it is. The others are joined with their rows of the list, which pick the
        partitions and bring labels; Spark broadcasts that list if its size allows it. ``where`` is the condition that chose the
        partitions, if one did: it spares row groups.
        """
        empty = self.spark.createDataFrame([], schema)
        own = F.col("labels").isNotNull() if "lead_days" in empty.columns else F.lit(False)
        each = files.groupBy("path").agg((F.bool_or(own) | (F.count("*") < F.max("of"))).alias("apart"))
        plain, apart = [], []
        for r in each.toLocalIterator():
            (apart if r["apart"] else plain).append(r["path"])
        if not plain and not apart:
            return empty

        def load(paths):
            cells = self.spark.read.schema(empty.schema).parquet(*map(unquote, paths))
            return cells if where is None else cells.where(where)

        parts = [load(plain)] if plain else []
        if apart:
            rows = files.join(each.where("apart").select("path"), "path", "left_semi") if plain else files
            rows = rows.select(F.col("path").alias("_path"), *[F.col(k).alias(f"_{k}") for k in PARTS], F.col("labels").alias("_labels"))
            same = [F.col("_file") == F.col("_path"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in PARTS]]
            cells = load(apart).select(*empty.columns, F.col("_metadata.file_path").alias("_file")).join(rows, same)
            if "lead_days" in empty.columns:
                of_kind = F.get(F.filter("_labels", lambda x: x["kind"].eqNullSafe(F.col("kind") if "kind" in empty.columns else F.lit(None))), F.lit(0))["leads"]
                cells = cells.withColumn("lead_days", F.when(of_kind.isNull(), F.col("lead_days")).otherwise(F.get(of_kind, F.col("lead_ix"))))
            parts.append(cells.select(*empty.columns))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    # -------------------------------------------------------------- writing

    def stage(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Write rows as new files that no version names yet: their folder, and their list as read back from them."""
        folder = f"{self.root}/data/commit-{uuid.uuid4().hex}"
        rows.repartition(*PARTS).sortWithinPartitions(*SLOT).write.option("maxRecordsPerFile", FILE_ROWS).parquet(folder)
        back = self.spark.read.schema(rows.schema).parquet(folder)
        # Counts of fields meet by file; slots, partitions and their number are found there without another shuffle.
        each = _field_counts(back.select("*", F.col("_metadata.file_path").alias("path")), "path").repartition("path")
        files = _sum_fields(each, "path").groupBy("path", *PARTS).agg(F.collect_list(F.struct("init_ts", "cells", "filled", "fields")).alias("slots"))
        files = files.withColumns({"labels": F.lit(None).cast(_LABELS), "of": F.count("*").over(Window.partitionBy("path"))})
        return folder, store(files.select(*_NAMES), "archive-files")

    def commit(self, base: int, add: DataFrame, drop: DataFrame | None = None) -> int:
        """The partitions of version ``base`` without those of ``drop`` (path, PARTS), and ``add``, as version base + 1.

        Raises ``Conflict`` if there is such a version already.
        """
        live = self.files(base)
        if drop is not None:
            gone = drop.select("path", *PARTS).withColumnsRenamed({k: f"_{k}" for k in ("path", *PARTS)})
            live = live.join(gone, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ("path", *PARTS)], "left_anti")
        return self._publish(base, live.select(*_NAMES).unionByName(add.select(*_NAMES)))

    def commit_labels(self, base: int, labels: DataFrame) -> int:
        """Version base + 1 with the same files, read with other lead labels.

        ``labels``: model, kind, var, init_date, leads (labels by position; null: as stored again). They hold for the files that the
        partition has now; files that are added later bring their own. Raises ``Conflict`` as ``commit`` does.
        """
        new = labels.groupBy(*[F.col(k).alias(f"_{k}") for k in PARTS]).agg(F.collect_list(F.struct(F.col("kind").cast("string").alias("kind"), F.col("leads").cast("array<float>").alias("leads"))).alias("_new"))
        both = self.files(base).join(new, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in PARTS], "left")
        replaced = lambda x: F.exists("_new", lambda y: y["kind"].eqNullSafe(x["kind"]))
        old = F.filter(F.coalesce("labels", F.array().cast(_LABELS)), lambda x: ~replaced(x))
        merged = F.concat(old, F.filter("_new", lambda y: y["leads"].isNotNull()))
        after = F.when(F.col("_new").isNull(), F.col("labels")).when(F.size(merged) > 0, merged)
        return self._publish(base, both.withColumn("labels", after).select(*_NAMES))

    def roll_back(self, version: int) -> int:
        """An earlier version's files again, as a new version."""
        return self._publish(self.version(), self.files(version))

    def _publish(self, base: int, live: DataFrame) -> int:
        name = uuid.uuid4().hex
        live.write.parquet(f"{self.root}/lists/{name}")
        made, to = self._path(f"{self.root}/log/_{name}"), self._path(f"{self.root}/log/v{base + 1}")
        stream = self._fs.create(made, False)
        stream.writeUTF(name)
        stream.close()
        jvm = self.spark._jvm
        try:
            if self._fs.getScheme() == "file":
                jvm.java.nio.file.Files.createLink(*[jvm.java.io.File(p.toUri().getPath()).toPath() for p in (to, made)])
            else:
                options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.spark._jsc.hadoopConfiguration()).rename(made, to, options)
        except Py4JJavaError as e:
            delete(self.spark, f"{self.root}/lists/{name}")
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"version {base + 1} is there already") from None
            raise
        finally:
            self._fs.delete(made, False)
        return base + 1

    def compact(self, schema, most: int = 4) -> int:
        """Rewrite partitions that lie in more than ``most`` files so that each lies in one, with the labels that they are read with.

        So are those in files of which less than half is live. Returns the version.
        """
        base = self.version()
        live = self.files(base)
        many = live.groupBy(*PARTS).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*PARTS)
        thin = live.groupBy("path").agg(F.count("*").alias("_n"), F.max("of").alias("_of")).where(2 * F.col("_n") < F.col("_of")).select("path")
        keys = many.union(live.join(thin, "path", "left_semi").select(*PARTS)).distinct().withColumnsRenamed({k: f"_{k}" for k in PARTS})
        old = store(live.join(keys, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in PARTS], "left_semi").select(*_NAMES), "archive-old")
        if old.isEmpty():
            return base
        folder, new = self.stage(self.read_files(old, schema))
        try:
            return self.commit(base, new, old)
        except Conflict:
            delete(self.spark, folder)
            raise
        finally:
            discard(old, new)

    def vacuum(self, keep: int = 1) -> int:
        """Delete data files that none of the newest ``keep`` versions names, and older versions; returns how many files.

        Only while nobody writes, or reads an older version.
        """
        newest = self.version()
        bare = lambda p: p.split(":", 1)[-1].lstrip("/")
        live = {bare(unquote(r["path"])) for v in range(max(1, newest - keep + 1), newest + 1) for r in self.files(v).select("path").distinct().toLocalIterator()}
        data, gone = self._path(f"{self.root}/data"), 0
        listing = self._fs.listFiles(data, True) if self._fs.exists(data) else None
        while listing is not None and listing.hasNext():
            path = listing.next().getPath()
            if path.getName().endswith(".parquet") and bare(path.toString()) not in live:
                self._fs.delete(path, False)
                gone += 1
        for v in range(1, newest - keep + 1):
            if self._fs.exists(self._path(f"{self.root}/log/v{v}")):
                delete(self.spark, f"{self.root}/lists/{self._list(v)}")
                self._fs.delete(self._path(f"{self.root}/log/v{v}"), False)
        return gone
