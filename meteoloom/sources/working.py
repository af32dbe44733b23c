"""Working folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}  # the folder made for a local application


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Only a local session (as in tests) may leave that unset; a temporary folder is then made, one for
    each application. Elsewhere executors would not see the driver's folder, so this raises.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        name = spark.sparkContext.applicationId
        if name not in _LOCAL:
            _LOCAL[name] = "file://" + tempfile.mkdtemp(prefix="meteoloom-")
        base = _LOCAL[name]
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, which cuts its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``store`` returned, once nothing reads them any more."""
    for df in tables:
        delete(df.sparkSession, df._stored_at)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
