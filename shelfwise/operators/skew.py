"""Joins and splits that hold when a few keys own a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that go to one task, on average.
ROWS_PER_SALT = 1_000_000


def hot_keys(
    counts: DataFrame, size: str, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Keys with more rows than one salt takes, and their number of ``salts``.

    A table of any length that is never collected; it has fewer rows than the counted
    table has multiples of ``rows_per_salt``, so that joins with it are cheap.
    """
    hot = counts.filter(F.col(size) > rows_per_salt)
    return hot.select(*keys, F.ceil(F.col(size) / rows_per_salt).alias("salts"))


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], hot: DataFrame) -> DataFrame:
    """Inner join to a side that has few rows per key, with ``hot_keys`` of the left side."""
    return salted_join(left, right, on, hot, left.columns)


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], hot: DataFrame, salt_by: Sequence[str]
) -> DataFrame:
    """Inner join whose left rows of hot keys are dealt to salts by a hash of ``salt_by``; their
    right rows are repeated per salt. A key that is not hot has the one salt 0.

    ``hot`` is keyed by one or more of the columns ``on``.
    """
    keys = [c for c in hot.columns if c != "salts"]
    count = F.coalesce("salts", F.lit(1).cast("bigint"))
    dealt = left.join(hot, keys, "left").withColumn("salt", hashed_chunk(count, *salt_by))
    repeated = right.join(hot, keys, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1))
    )
    joined = dealt.drop("salts").join(repeated.drop("salts"), [*on, "salt"])
    others = [c for c in left.columns if c not in on]
    return joined.select(*on, *others, *[c for c in right.columns if c not in on])


def triangle(df: DataFrame, chunk: Column, chunks: Column) -> DataFrame:
    """Give each row one copy per chunk it must meet: columns chunk, lo, hi.

    All pairs among a group of ``chunks`` chunks are covered by the keys
    ``lo <= hi``, each of which sees two chunks only. A hot group is thereby
    spread over many bounded tasks, and every pair meets exactly once.
    """
    return (
        df.withColumn("chunk", chunk.cast("int"))
        .withColumn("partner", F.explode(F.sequence(F.lit(0), chunks.cast("int") - 1)))
        .withColumn("lo", F.least("chunk", "partner"))
        .withColumn("hi", F.greatest("chunk", "partner"))
        .drop("partner")
    )


def hashed_chunk(chunks: Column, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), chunks.cast("bigint"))
