"""Product and rating text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import field, number


def product_columns(line: Column, strict: bool = True) -> list[Column]:
    """Fields 0, 1, 4, 5 and 6 of a caret-separated line; a missing text is empty."""

    def text(index: int) -> Column:
        return F.coalesce(F.trim(field(line, "^", index)), F.lit(""))

    return [
        number(field(line, "^", 0), "int", strict).alias("productId"),
        text(1).alias("name"),
        text(4).alias("imageUrl"),
        text(5).alias("categories"),
        text(6).alias("tags"),
    ]


def rating_columns(line: Column, separator: str = ",", strict: bool = True) -> list[Column]:
    """Fields 0 to 3 of a rating line; further fields are ignored."""
    kinds = {"userId": "int", "productId": "int", "score": "double", "timestamp": "int"}
    return [
        number(field(line, separator, index), kind, strict).alias(name)
        for index, (name, kind) in enumerate(kinds.items())
    ]


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Products from text; a line without a valid id fails the job."""
    lines = spark.read.text(path)
    return lines.select(*product_columns(F.col("value")))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings from text; a line with a bad number fails the job."""
    lines = spark.read.text(path)
    return lines.select(*rating_columns(F.col("value")))


def split_bad(lines: DataFrame, columns: list[Column], required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that miss a required field, in place of a failed job.

    ``columns`` are built with ``strict=False`` over the column ``value``.
    """
    parsed = lines.select("value", *columns)
    good = F.lit(True)
    for name in required:
        good = good & F.col(name).isNotNull()
    return parsed.filter(good).drop("value"), parsed.filter(~good).select("value")
