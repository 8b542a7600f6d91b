"""Products, ratings, log lines and vectors derived from the test tables.

Each frame has a twin in SQL, used to state expected results in another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import settings


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def ratings(spark: SparkSession, base: str) -> DataFrame:
    """One rating per line item: the order's customer rates the part."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    lines = table(spark, base, "lineitem")
    orders = table(spark, base, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        (1 + F.col("l_quantity").cast("int") % 5).cast("double").alias("score"),
        F.timestamp_diff("SECOND", epoch, F.col("o_orderdate")).cast("int").alias("timestamp"),
    )


RATINGS_SQL = """
SELECT CAST(o_custkey AS INTEGER) AS "userId", CAST(l_partkey AS INTEGER) AS "productId",
       CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS DOUBLE) AS score,
       CAST(epoch(o_orderdate) AS INTEGER) AS "timestamp"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def products(spark: SparkSession, base: str) -> DataFrame:
    """One product per part; name words, brand, type and size are the tags."""
    tags = F.concat_ws(
        "|",
        F.translate("p_name", " ", "|"),
        "p_brand",
        "p_type",
        F.concat(F.lit("size"), F.col("p_size").cast("string")),
    )
    return table(spark, base, "part").select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.lit("").alias("imageUrl"),
        F.col("p_type").alias("categories"),
        tags.alias("tags"),
    )


PRODUCTS_SQL = """
SELECT CAST(p_partkey AS INTEGER) AS "productId", p_name AS name, '' AS "imageUrl",
       p_type AS categories,
       replace(p_name, ' ', '|') || '|' || p_brand || '|' || p_type || '|size' || p_size AS tags
FROM part
"""


def vectors(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def rating_text(separator: str) -> F.Column:
    return F.concat_ws(
        separator,
        F.col("userId"),
        F.col("productId"),
        F.col("score").cast("decimal(4,1)"),
        F.col("timestamp"),
    )


def log_lines(spark: SparkSession, base: str) -> DataFrame:
    """Every rating as a prefixed log line, and every event's properties as noise."""
    rating_lines = ratings(spark, base).select(
        F.concat(F.lit("INFO " + settings.LOG_PREFIX), rating_text("|")).alias("value")
    )
    noise = table(spark, base, "events").select(F.col("props").alias("value"))
    return rating_lines.unionByName(noise)


LOG_LINES_SQL = """
SELECT 'INFO PRODUCT_RATING_PREFIX:' || "userId" || '|' || "productId" || '|'
       || CAST(CAST(score AS DECIMAL(4,1)) AS VARCHAR) || '|' || "timestamp" AS value FROM ratings
UNION ALL
SELECT props AS value FROM events
"""


def predictions(spark: SparkSession, base: str) -> DataFrame:
    """The product's mean score as the prediction for each rated pair."""
    means = ratings(spark, base).groupBy("productId").agg(F.avg("score").alias("prediction"))
    pairs = ratings(spark, base).select("userId", "productId").distinct()
    return pairs.join(means, "productId").select("userId", "productId", "prediction")
