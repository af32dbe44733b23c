"""Streams: archive catch-up from a landing folder (R1) and crossing counts (R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.archive import sync_archive
from ..operators.normalise import join_null_safe
from ..sources.cube import SCHEMA, missing_to_null
from ..sources.snapshots import SLOT
from ..sources.working import discard, store
from .assembly import assembled_slots


def landing_stream(spark: SparkSession, landing: str, archive: str, checkpoint: str, n: int = 4, expected: DataFrame | None = None, wait_ms: int = 2 * 24 * 3600 * 1000) -> StreamingQuery:
    """Files that arrive in the landing folder go to the archive, a ``snapshots.Archive``.

    Each micro-batch drops all-missing files, appends new starts, adds variables, backfills the last ``n`` starts and
    extends stored slots by fields (member and lead) that they lack. A batch that is replayed after a failure finds its
    fields stored and writes nothing twice.

    With ``expected`` (model, var, fields) a slot goes to the archive once all its fields have landed, or after
    ``wait_ms``; until then it is state. Its cells are then read from the landing folder, which must hold
    them so long. Waits are looked at whenever something lands.
    """
    source = spark.readStream.schema(SCHEMA).parquet(landing)

    def sync(batch: DataFrame) -> None:
        sync_archive(missing_to_null(batch), archive, n, skip_empty=True)

    def ready(batch: DataFrame, epoch: int) -> None:
        slots = store(batch.select("model", "var", "init_date", F.col("init_ts").cast("timestamp_ntz").alias("init_ts")).distinct(), "ready-slots")
        if not slots.isEmpty():
            sync(join_null_safe(spark.read.schema(SCHEMA).parquet(landing), slots, SLOT, "left_semi"))
        discard(slots)

    rows = source if expected is None else assembled_slots(source, expected, wait_ms)
    each = ready if expected is not None else lambda batch, epoch: sync(batch)
    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.start() if expected is None else _started(spark, writer)


#: Keyed state with timers is kept in RocksDB. Batches without data would follow each other for ever while a timer may be set.
_KEYED = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def _started(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Start a stream with these settings; a stream copies the session's when it starts, so they are put back at once."""
    before = {k: spark.conf.get(k, None) for k in _KEYED}
    for k, v in _KEYED.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def crossing_counts(events: DataFrame, threshold: float, key: str = "user_id", time: str = "ts", late: str = "2 days") -> DataFrame:
    """R2: per key and sliding week (by day) the number of events above the threshold and of all.

    Works on a stream (with a watermark, so that state is bounded) and on a table alike.
    """
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    held = events.withWatermark(time, late) if events.isStreaming else events
    return held.groupBy(F.window(time, "7 days", "1 day").alias("w"), key).agg(F.count_if(F.col("value") > threshold).alias("crossings"), F.count("*").alias("n"))


def crossing_stream(events: DataFrame, out: str, checkpoint: str, threshold: float, min_crossings: int = 1) -> StreamingQuery:
    """R2 as a job: finished windows with enough crossings are appended as Parquet."""
    counts = crossing_counts(events, threshold).where(F.col("crossings") >= min_crossings)
    flat = counts.select("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "crossings", "n")
    return flat.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
