"""The two rating streams: log lines to rating messages, rating messages to lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise import schemas, settings
from shelfwise.functions.columns import field, payload
from shelfwise.plans import online
from shelfwise.sources import batches
from shelfwise.sources.text import rating_columns


def rating_messages(lines: DataFrame, prefix: str = settings.LOG_PREFIX) -> DataFrame:
    """Log lines with the prefix as messages (key, value); works on streams and tables.

    Messages are keyed by user, which spreads them over the topic's partitions and
    keeps a user's ratings in order. Lines without text after the prefix are dropped.
    """
    value = payload(F.col("value"), prefix)
    return (
        lines.filter(F.col("value").contains(prefix))
        .select(value.alias("value"))
        .filter(F.length("value") > 0)
        .select(field(F.col("value"), "|", 0).alias("key"), "value")
    )


def rating_events(messages: DataFrame, strict: bool = True) -> DataFrame:
    """Bar-separated messages as ratings; a bad one fails the job or, when not strict,
    is left out. ``sorted_messages`` keeps bad ones with the reason."""
    parsed = messages.select(*rating_columns(F.col("value"), "|", strict))
    return parsed if strict else parsed.dropna()


def sorted_messages(messages: DataFrame) -> DataFrame:
    """Messages as ratings with two columns more: of a bad message ``line``, its text, and
    ``reason``, the first field that cannot be read, with all fields null."""
    parsed = messages.select("value", *rating_columns(F.col("value"), "|", strict=False))
    reason = F.lit(None).cast("string")
    for column in reversed(schemas.RATING.fields):
        said = F.lit(f"{column.name} is not a valid {column.dataType.simpleString()}")
        reason = F.when(F.col(column.name).isNull(), said).otherwise(reason)
    parsed = parsed.withColumn("reason", reason)
    good = F.col("reason").isNull()
    fields = [F.when(good, F.col(name)).alias(name) for name in schemas.RATING.names]
    return parsed.select(*fields, F.when(~good, F.col("value")).alias("line"), "reason")


def route_messages(good_path: str, bad_path: str, run: int = 1) -> Callable[[DataFrame, int], None]:
    """The action on each micro-batch of ``sorted_messages``: ratings to one table, bad lines
    with their reason to another. Both are tables of batches, so a replay writes both again to
    the same folders and adds nothing."""

    def route(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        try:
            batches.write_batch(rows.filter("reason is null").select(*schemas.RATING.names), good_path, batch, run)
            batches.write_batch(rows.filter("reason is not null").select("line", "reason"), bad_path, batch, run)
        finally:
            rows.unpersist()

    return route


def update_lists(
    history: DataFrame, ranked: DataFrame, history_path: str, lists_path: str,
    report: Callable[[int, int], None] | None = None, run: int = 1, **parameters,
) -> Callable[[DataFrame, int], None]:
    """The action on each micro-batch: add it to the history, then write its users' lists.

    ``report`` gets the batch number and how many users were skipped, because their
    newest event is on a product without a similarity list. ``run`` numbers the checkpoint;
    a job that starts with a new one over kept tables takes ``batches.next_run``.
    Each micro-batch reads the whole history; ``streaming.lists`` has the job that does not.
    """

    def update(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        batches.write_batch(events, history_path, batch, run)
        arrived = batches.read_batches(spark, history_path, schemas.RATING)
        arrived = arrived.filter((F.col("run") < run) | (F.col("batch") <= batch))
        known = history.unionByName(arrived.drop("run", "batch"))
        mine = arrived.filter((F.col("run") == run) & (F.col("batch") == batch)).drop("run", "batch")
        counts: dict[str, int] = {}
        lists = online.recommend(mine, known, ranked, counts=counts, **parameters)
        batches.write_batch(lists, lists_path, batch, run)
        if report:
            report(batch, counts["skipped"])

    return update


def start_lists(
    events: DataFrame, history: DataFrame, ranked: DataFrame, history_path: str,
    lists_path: str, checkpoint: str, available_now: bool = False, **parameters,
) -> StreamingQuery:
    """Keep per-user lists current from a stream of ratings.

    Every micro-batch looks into ``ranked`` and ``history``; persist them before, so
    that each executor holds its part of them.
    """
    writer = (
        events.writeStream.foreachBatch(
            update_lists(history, ranked, history_path, lists_path, **parameters)
        )
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=settings.MICRO_BATCH)
    return writer.start()
