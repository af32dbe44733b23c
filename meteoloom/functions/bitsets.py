"""Sets of small numbers as 64-bit words: days of starts, members. A row holds the numbers 64 * word to 64 * word + 63.

Words are made and merged by aggregates that combine before they shuffle, and sets are compared word by word in place
of row by row: a year of daily starts is six or seven words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(df: DataFrame, keys, number: Column) -> DataFrame:
    """keys, word, bits of the distinct numbers (any whole number; null: none) of each key."""
    n = number.cast("bigint")
    named = df.where(number.isNotNull()).select(*keys, F.floor(n / 64).alias("word"), F.pmod(n, F.lit(64)).cast("int").alias("_bit"))
    return named.groupBy(*keys, "word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("bits"))


def minus(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """keys, word, bits of what left has and right lacks; keys may be null."""
    from ..operators.normalise import join_null_safe

    both = join_null_safe(left, right.withColumnRenamed("bits", "_bits"), [*keys, "word"], "left")
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_bits", F.lit(0).cast("bigint"))))
    return both.select(*keys, "word", rest.alias("bits")).where("bits <> 0")


def counts(sets: DataFrame, keys) -> DataFrame:
    """keys, n: how many numbers."""
    return sets.groupBy(*keys).agg(F.sum(F.bit_count("bits").cast("bigint")).alias("n"))


def numbers(sets: DataFrame, keys) -> DataFrame:
    """keys, number: one row for each number of the sets."""
    own = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("bits", i) == 1)
    return sets.select(*keys, "word", F.explode(own).alias("_bit")).select(*keys, (F.col("word") * 64 + F.col("_bit")).alias("number"))


def within(sets: DataFrame, first: int, last: int) -> DataFrame:
    """The same sets without numbers outside [first, last]; words without any number left go."""
    near = sets.where(F.col("word").between(first // 64, last // 64))
    low, high = f"greatest(0, {first} - 64 * word)", f"greatest(0, 64 * word + 63 - {last})"
    mask = F.expr(f"shiftleft(-1L, cast({low} AS INT)) & shiftrightunsigned(-1L, cast({high} AS INT))")
    return near.withColumn("bits", F.col("bits").bitwiseAND(mask)).where("bits <> 0")


def greatest_number(sets: DataFrame, keys) -> DataFrame:
    """keys, number: the greatest of each key's numbers."""
    own = F.col("word") * 64 + F.length(F.bin("bits")) - 1  # bin has no leading zeros, and 64 digits once the last bit is set
    return sets.groupBy(*keys).agg(F.max(own).alias("number"))
