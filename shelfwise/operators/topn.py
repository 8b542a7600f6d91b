"""Top-N per key, ranks of whole lists, and the nested list form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise import settings
from shelfwise.functions.columns import recommendation
from shelfwise.session import fresh_path, released_shuffles

LIST_PART = 1000


def order_key(score: str = "score") -> Column:
    """The score in units of the last compared digit, as a bigint."""
    return F.floor(F.col(score) * 10**settings.SCORE_DIGITS + 0.5)


def top_n(
    df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows per key, numbered from 1.

    Spark cuts each map task's rows to ``n`` per key before the shuffle, so a hot
    key sends at most ``n`` rows per task. ``order`` should hold plain columns:
    expressions would be computed again for every comparison.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def top_scores(df: DataFrame, key: str, n: int, tie: str = "recProductId") -> DataFrame:
    """The ``n`` best scores per key; equal ones go by the smaller id."""
    keyed = df.withColumn("order_key", order_key())
    return top_n(keyed, [key], [F.col("order_key").desc(), F.col(tie).asc()], n).drop("order_key")


def rank_lists(pairs: DataFrame, key: str = "productId", path: str | None = None) -> DataFrame:
    """Number every row of every list, best first, without one task per key: adds
    ``rank`` and the list's ``length``.

    Rows are range-sorted by key, score and id, so a long list spans many
    partitions, and stored with their position. The rank is the position inside the
    partition, counted from the key's first row there, plus the key's rows in the
    partitions before it. Storing keeps positions stable when an executor is lost.
    """
    spark = pairs.sparkSession
    order = [F.col(key), F.col("order_key").desc(), F.col("recProductId")]
    path = path or fresh_path(spark, "sorted-lists")
    rows = (
        pairs.withColumn("order_key", order_key())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("order_key")
        .withColumn("position", F.monotonically_increasing_id())
    )
    with released_shuffles(spark):
        rows.write.mode("overwrite").parquet(path)
    # The upper bits of the position are the partition.
    stored = spark.read.parquet(path).withColumn("part", F.shiftright("position", 33))
    parts = Window.partitionBy(key)
    before = parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(key, "part")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("position").alias("first"))
        .select(
            key,
            "part",
            (F.coalesce(F.sum("rows").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"),
            F.sum("rows").over(parts).alias("length"),
        )
    )
    return stored.join(starts, [key, "part"]).select(
        *pairs.columns, (F.col("position") + F.col("shift")).alias("rank"), "length"
    )


def to_lists(
    ranked: DataFrame, key: str = "productId", rec: str = "recProductId",
    part_rows: int = LIST_PART, overlap: int = 0,
) -> DataFrame:
    """Ranked rows as arrays of (productId, score): columns key, part, recs.

    A list of up to ``part_rows`` entries is one row with part 0. A longer one
    continues in the next part, so no array grows without bound. With ``overlap`` a part
    also ends with so many entries of the next one, ``part_rows`` at most.
    """
    part = F.floor((F.col("rank") - 1) / part_rows).cast("int").alias("part")
    entry = F.struct(F.col("rank"), F.col(rec).alias("rec"), F.col("score"))
    if overlap:
        again = (part > 0) & (F.pmod(F.col("rank") - 1, F.lit(part_rows)) < overlap)
        parts = F.when(again, F.array(part, part - 1)).otherwise(F.array(part))
        ranked = ranked.select(key, "rank", rec, "score", F.explode(parts).alias("part"))
        part = F.col("part")
    return (
        ranked.groupBy(key, part)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(
            key,
            "part",
            F.transform("entries", lambda e: recommendation(e["rec"], e["score"])).alias("recs"),
        )
    )


def to_ranked(lists: DataFrame, key: str = "productId", part_rows: int = LIST_PART) -> DataFrame:
    """The flat form of nested lists: key, rank, recProductId, score."""
    part = F.col("part") if "part" in lists.columns else F.lit(0)
    return lists.select(
        key, part.alias("part"), F.posexplode("recs").alias("pos", "rec")
    ).select(
        key,
        (F.col("part") * part_rows + F.col("pos") + 1).cast("bigint").alias("rank"),
        F.col("rec.productId").alias("recProductId"),
        F.col("rec.score").alias("score"),
    )


def merge_lists(
    old: DataFrame, new: DataFrame, n: int, key: str = "userId"
) -> DataFrame:
    """Union of two flat lists keeping the higher score per product, then the top ``n``.

    Both lists are dealt out again before they are merged: lists that are already cut by ``key`` would otherwise be
    sorted, merged and cut again in one task, which then holds all of these at a time.
    """
    columns = [key, "recProductId", "score"]
    both = old.select(*columns).unionByName(new.select(*columns)).repartition(key, "recProductId")
    merged = top_n(both, [key, "recProductId"], [F.col("score").desc()], 1, "place").drop("place")
    return top_scores(merged, key, n)
