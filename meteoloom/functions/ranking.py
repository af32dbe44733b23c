"""Row numbers over a whole table without a window in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.working import store


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``, the row number from 1 in the given order (total, or ties are numbered as they come).

    Rows are ranged into blocks, numbered inside each, and moved by the number of rows in the
    blocks before, a list with a row for each block. The blocks are stored first, as ranging
    samples its borders anew wherever it is computed.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = store(df.repartitionByRange(n, *order).withColumn("_block", F.spark_partition_id()), "ranked")
    sizes = blocks.groupBy("_block").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("_block").alias("_b"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    out = blocks.withColumn(name, inside).join(F.broadcast(sizes), F.col("_block") == F.col("_b"))
    return out.withColumn(name, (F.col(name) + F.col("_before")).cast("int")).drop("_block", "_b", "_before")
