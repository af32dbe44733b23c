"""Size-tiered compaction of document shards (DataFrame functions only).

Arrivals are appended as small immutable Parquet shards. A shard's tier is the power of
``fanin`` that its bytes reach over the smallest size; whenever a tier holds ``fanin`` shards
below the target size, they form a run and are merged into files of about the target size.
Every change is a new manifest: the list of live shards, written in full to a folder of its own.
The version is the file ``v<N>`` that names this folder. It comes into being in one step that
fails if the file exists (a link on a local file system, elsewhere a rename without overwriting),
so of two writers of one version exactly one succeeds, and readers always see one whole version.
The other writer raises ``Conflict`` and may try again from the new version. Files that no live
shard names can be swept at any later time.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialize

#: Size of a full shard. Fit for tables of gigabytes; give 512 MB or more for hundreds of terabytes.
TARGET_BYTES = 32 << 20
FANIN = 4
SMALLEST = 1 << 20
#: Shards that one round of compaction merges at most; what is left is due in the next round.
ROUND_SHARDS = 20_000
#: Batches in which the registered query lets its table arrive.
ARRIVALS = 4
MANIFEST = "path string, tier int, rows long, bytes long, born long"


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class ShardStore:
    """A folder of shards and manifests in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str, target: int = TARGET_BYTES, fanin: int = FANIN, smallest: int = SMALLEST):
        self.spark, self.root = spark, root.rstrip("/")
        self.target, self.fanin, self.smallest = target, fanin, smallest
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/manifest"))

    # -------------------------------------------------------------- versions

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/manifest"))]
        return max([0, *(int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit())])

    def manifest(self, version: int | None = None) -> DataFrame:
        """Live shards of a version: path, tier, rows, bytes, born (the version that made it)."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in (x.split() for x in MANIFEST.split(", "))])
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/lists/{self._named(version)}")

    def _named(self, version: int) -> str:
        """The folder that a version's file names."""
        stream = self._fs.open(self._path(f"{self.root}/manifest/v{version}"))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def _claim(self, made: str, to: str) -> None:
        """Give the file ``made`` the name ``to`` in one step, or raise ``Conflict`` if there is one."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        made_path, to_path = self._path(made), self._path(to)
        try:
            if self._fs.getScheme() == "file":
                files = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (to_path, made_path)]
                jvm.java.nio.file.Files.createLink(*files)
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to_path.toUri(), self.spark._jsc.hadoopConfiguration())
                context.rename(made_path, to_path, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"{to} is there already; read the manifest again and retry") from None
            raise

    def _commit(self, live: DataFrame, base: int) -> int:
        """Write ``live`` as version base + 1, or raise ``Conflict`` if another writer was first."""
        name = uuid.uuid4().hex
        live.select(*[x.split()[0] for x in MANIFEST.split(", ")]).coalesce(8).write.parquet(f"{self.root}/lists/{name}")
        made = f"{self.root}/manifest/_{name}"
        stream = self._fs.create(self._path(made), False)
        stream.writeUTF(name)
        stream.close()
        try:
            self._claim(made, f"{self.root}/manifest/v{base + 1}")
        except Conflict:
            self._fs.delete(self._path(f"{self.root}/lists/{name}"), True)
            raise
        finally:
            self._fs.delete(self._path(made), False)
        if self._named(base + 1) != name:
            raise Conflict(f"version {base + 1} names another list")
        return base + 1

    # -------------------------------------------------------------- shards

    def _described(self, folder: str, tier, born: int) -> DataFrame:
        """Manifest rows of the files under ``folder``: rows and bytes of each."""
        rows = self.spark.read.parquet(folder)
        file = rows.metadataColumn("_metadata")  # even if the documents have a column of that name
        per = rows.groupBy(file["file_path"].alias("path"), file["file_size"].alias("bytes")).agg(F.count("*").alias("rows"))
        return per.select("path", tier(F.col("bytes")).cast("int").alias("tier"), "rows", "bytes", F.lit(born).cast("long").alias("born"))

    def _tier(self, size):
        """0 up to the smallest size, then one more for each factor ``fanin``."""
        return F.greatest(F.lit(0), F.ceil(F.log(float(self.fanin), size / F.lit(float(self.smallest)))))

    def append(self, arrivals: DataFrame) -> int:
        """Append ``arrivals`` as small shards in one version; no rows change nothing."""
        base, folder = self.version(), f"{self.root}/data/{uuid.uuid4().hex}"
        arrivals.write.option("compression", "zstd").parquet(folder)
        new = materialize(self._described(folder, self._tier, base + 1), "shards-new")
        try:
            if new.isEmpty():
                return base
            return self._commit(self.manifest(base).unionByName(new), base)
        finally:
            discard(new)

    def plan(self, version: int | None = None) -> DataFrame:
        """Runs to merge: path, bin (0, 1, ... the merged file) and bytes. Empty when nothing is due.

        A tier is due with ``fanin`` or more shards below the target. Its shards, oldest first,
        are cut into runs of about the target size; a run of a single shard stays as it is.
        Works on the manifest alone, which has one row for each shard.
        """
        live = self.manifest(version).where(F.col("bytes") < self.target)
        tier = Window.partitionBy("tier")
        order = tier.orderBy("born", "path")
        due = live.withColumn("_n", F.count("*").over(tier)).where(F.col("_n") >= self.fanin)
        before = F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        due = due.withColumn("_run", F.floor((before + F.col("bytes") / 2) / F.lit(self.target)))
        run = Window.partitionBy("tier", "_run")
        due = due.withColumn("_in", F.count("*").over(run)).where("_in > 1")
        return due.select("path", (F.dense_rank().over(Window.orderBy("tier", "_run")) - 1).alias("bin"), "bytes")

    def compact(self) -> int:
        """One round: merge due runs, at most ``ROUND_SHARDS`` shards of them, and commit.

        Returns the version (unchanged if no run was due).
        """
        base = self.version()
        # A list of file names and run numbers, bounded; the rows themselves never reach the driver.
        plan = self.plan(base).orderBy("bin", "path")
        runs = [(r["path"], r["bin"]) for r in plan.limit(ROUND_SHARDS + 1).collect()]
        if len(runs) > ROUND_SHARDS:  # whole runs only, unless one alone is larger
            runs = [r for r in runs if r[1] < runs[-1][1]] or runs[:-1]
        if not runs:
            return base
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        rows = self.spark.read.parquet(*[p for p, _ in runs])
        # The documents' columns travel as one, so that none clashes.
        rows = rows.select(F.struct("*").alias("doc"), rows.metadataColumn("_metadata")["file_path"].alias("file"))
        names = plan.limit(len(runs)).select(F.col("path").alias("path__"), F.col("bin"))
        merged = rows.join(F.broadcast(names), F.col("file") == F.col("path__")).select("doc", "bin")
        # A run's rows go to the task of its number, which writes the merged file; the target bounds them.
        merged.repartitionById(runs[-1][1] + 1, F.col("bin")).select("doc.*").write.option("compression", "zstd").parquet(folder)
        new = self._described(folder, self._tier, base + 1)
        kept = self.manifest(base).join(F.broadcast(names), F.col("path") == F.col("path__"), "left_anti")
        return self._commit(kept.unionByName(new), base)

    def settle(self) -> int:
        """Compact until no tier is due; every round leaves fewer shards, so that this ends."""
        before, now = -1, self.version()
        while now != before:
            before, now = now, self.compact()
        return now

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, as its live shards hold them.

        Their names are listed on the driver, as Spark does for any table that it reads.
        """
        paths = [r["path"] for r in self.manifest(version).select("path").toLocalIterator()]
        return self.spark.read.parquet(*paths)

    def sweep(self, keep: int = 1) -> int:
        """Delete shard files that none of the newest ``keep`` versions names; returns how many.

        Only for a store that no job still reads at an older version.
        """
        newest = self.version()
        versions = range(max(1, newest - keep + 1), newest + 1)
        strip = lambda p: p.split(":", 1)[-1].lstrip("/")
        live = {strip(r["path"]) for v in versions for r in self.manifest(v).select("path").toLocalIterator()}
        gone, listing = 0, self._fs.listFiles(self._path(f"{self.root}/data"), True)
        while listing.hasNext():
            path = listing.next().getPath()
            if path.getName().endswith(".parquet") and strip(path.toString()) not in live:
                self._fs.delete(path, False)
                gone += 1
        for v in range(1, versions.start):
            file = self._path(f"{self.root}/manifest/v{v}")
            if self._fs.exists(file):
                self._fs.delete(self._path(f"{self.root}/lists/{self._named(v)}"), True)
                self._fs.delete(file, False)
        return gone


def arrival_of(doc_id: Column, n: int = ARRIVALS) -> Column:
    """The arrival, 0..n-1, by a hash of doc_id."""
    return F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("null"))), F.lit(n)).cast("int")


def shard_documents(docs: DataFrame, root: str, target: int = TARGET_BYTES, fanin: int = FANIN, smallest: int = SMALLEST, arrivals: int = ARRIVALS) -> tuple[ShardStore, int]:
    """Append ``docs`` arrival by arrival with compaction in between; returns store and version.

    Each arrival is a version of its own, and so is each round of compaction; shards that only
    older versions name are deleted as it goes. Every row is kept as it is, with all its columns
    (nulls and repeats included). An empty table commits no shard, and its store stays at
    version 0.
    """
    store = ShardStore(docs.sparkSession, root, target, fanin, smallest)
    for k in range(arrivals):
        store.append(docs.where(arrival_of(F.col("doc_id"), arrivals) == k))
        store.settle()
        store.sweep()
    return store, store.version()


def shard_digest(docs: DataFrame, root: str) -> DataFrame:
    """What the registered query returns: each document as read back from the committed shards.

    doc_id, source, lang, n_bytes and text_sha256 (null text: nulls); ``store_rows``, the rows that
    the manifest counts, and ``settled``, whether no run of shards is left to merge.
    """
    docs = docs.select("doc_id", "text", "lang", "source")
    store, version = shard_documents(docs, root)
    rows = store.read(version) if version else docs.limit(0)
    counted = store.manifest(version).agg(F.sum("rows")).first()[0]
    facts = F.lit(counted).cast("long").alias("store_rows"), F.lit(store.plan(version).isEmpty()).alias("settled")
    return rows.select("doc_id", "source", "lang", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"), *facts)
