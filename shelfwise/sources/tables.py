"""Batch tables: typed scans, overwriting sinks, similarity lists, stored intermediates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas
from shelfwise.session import fresh_path, released_shuffles


def scan(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet",
    strict: bool = False, **options: str,
) -> DataFrame:
    """Read a table in the given schema; extra stored columns are not read.

    ``strict`` fails on nulls where the schema has none. That check hides the
    columns from filter pushdown, so it is off unless the source is not trusted.
    """
    frame = spark.read.format(format).options(**options).load(path)
    return schemas.conform(frame, schema, strict)


def write(
    df: DataFrame, path: str, format: str = "parquet", cluster_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Replace the table at ``path``.

    ``cluster_by`` sorts the table by its lookup columns, over range partitions, so
    that readers skip files and row groups. A hot key may span several files.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    with released_shuffles(df.sparkSession):
        df.write.format(format).options(**options).mode("overwrite").save(path)


def write_products_and_ratings(
    products: DataFrame, ratings: DataFrame, base: str, format: str = "parquet"
) -> tuple[str, str]:
    """Store both base tables, clustered by their lookup columns."""
    product_path, rating_path = f"{base}/products", f"{base}/ratings"
    write(products, product_path, format, ["productId"])
    write(ratings, rating_path, format, ["userId", "productId"])
    return product_path, rating_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Store an intermediate in the shared folder and go on from the stored table.

    Later steps read it instead of computing it again, also after lost executors. What was shuffled
    for it is removed.
    """
    path = fresh_path(df.sparkSession, name)
    with released_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def list_pairs(lists: DataFrame) -> DataFrame:
    """Nested similarity lists as one row per (product, similar product)."""
    flat = lists.select("productId", F.explode("recs").alias("rec")).select(
        "productId",
        F.col("rec.productId").alias("recProductId"),
        F.col("rec.score").alias("score"),
    )
    return schemas.conform(flat, schemas.PAIR, strict=False)


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, format: str = "parquet"
) -> DataFrame:
    """Store a table in hash buckets of its lookup column, sorted inside, and read it back.

    The catalog knows the layout: joins and aggregations by ``key`` need no exchange of this table, and
    two tables with the same key and number of buckets meet bucket by bucket. Rows are dealt to their buckets
    before they are written, so each bucket is one file unless it is very large. Readers in another session use
    ``spark.table(table)`` where the catalog is shared. An existing table of the name is replaced.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, key)
    writer = dealt.write.format(format).bucketBy(buckets, key).sortBy(key).mode("overwrite")
    writer.option("path", path).saveAsTable(table)
    return spark.table(table)


def use_buckets(spark: SparkSession, wide: bool = True) -> None:
    """Whether joins by more columns than a bucketed table's key stay inside its buckets, too.

    Off by default in Spark: a join by (product, other) then shuffles both sides by both columns, which
    spreads a hot product but moves the whole table.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", str(not wide).lower())
