"""Streaming sources and sinks. The format is a parameter: a broker in production,
text files where there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from shelfwise import settings


def topic_options(servers: str, topic: str = settings.RATING_TOPIC, **options: str) -> dict[str, str]:
    """Options of a broker topic, read from its newest offsets on the first start."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "kafka.group.id": topic,
        **options,
    }


def read_lines(spark: SparkSession, format: str = "text", **options: str) -> DataFrame:
    """A stream of text lines in column ``value``."""
    stream = spark.readStream.format(format).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def write_lines(
    lines: DataFrame, checkpoint: str, format: str = "text", available_now: bool = False,
    **options: str,
) -> DataStreamWriter:
    """A writer for ``value`` (and ``key``) columns; call ``start()`` on it.

    Restarts go on from the checkpoint folder.
    """
    if format != "kafka":
        lines = lines.select("value")
    writer = (
        lines.writeStream.format(format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=settings.MICRO_BATCH)
