"""The online job on kept state: no micro-batch reads more of the past than its own users' rows.

The recent ratings of each user are stream state. All ratings and the current lists are keyed
tables, which a micro-batch reads and rewrites in the buckets of its users.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise import schemas, settings
from shelfwise.plans import online
from shelfwise.sources import batches
from shelfwise.sources.keyed import KeyedTable
from shelfwise.sources.tables import materialize
from shelfwise.streaming import recent
from shelfwise.streaming.ratings import sorted_messages

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEAD = T.StructType([T.StructField(name, T.StringType()) for name in ("line", "reason")])
#: The batch number of ratings that were there before the stream.
BEFORE = 0


@dataclass
class OnlineTables:
    """The tables of a job below one folder: all ``ratings``, current ``lists``, and bad messages."""

    spark: SparkSession
    base: str
    buckets: int = 64

    def __post_init__(self) -> None:
        self.ratings = KeyedTable(self.spark, f"{self.base}/ratings", schemas.RATING, "userId", self.buckets)
        self.lists = KeyedTable(self.spark, f"{self.base}/lists", schemas.USER_LIST, "userId", self.buckets)
        self.dead_path = f"{self.base}/dead"

    def seed(self, history: DataFrame) -> None:
        """Take over ratings of before the stream, once; a table that has any is left alone."""
        if self.ratings.manifest()["version"] == 0:
            self.ratings.append(history, BEFORE, run=0)

    def dead_letters(self) -> DataFrame:
        """Bad messages with the reason, and the run and batch they came with."""
        if batches.next_run(self.spark, self.dead_path) == 1:
            return self.spark.createDataFrame([], "line string, reason string, run bigint, batch bigint")
        return batches.read_batches(self.spark, self.dead_path, DEAD)


def update_tables(
    tables: OnlineTables, ranked: DataFrame, merge: bool = False, run: int = 1,
    report: Callable[[int, dict], None] | None = None, **parameters,
) -> Callable[[DataFrame, int], None]:
    """The action on each micro-batch of ``recent.with_recent`` rows and bad messages.

    ``merge`` keeps what is better in a user's old list (``online.merge_with_old``); else the new
    list takes its place. Every table skips a batch that it has applied, so a job that was lost
    between two writes makes the missing ones when the batch is replayed. ``report`` gets the batch
    number and counts of ``users``, those ``skipped`` for an unknown product, ``ratings`` and ``dead`` messages.
    """

    def update(rows: DataFrame, batch: int) -> None:
        seen = {"ratings": 0, "dead": 0}
        count = Observation()
        rows = materialize(
            rows.observe(
                count,
                F.count_if(F.col("reason").isNull() & F.col("rank").isNull()).alias("ratings"),
                F.count("reason").alias("dead"),
            ),
            "micro-batch",
        )
        seen |= {name: value or 0 for name, value in count.get.items()}
        bad = rows.filter("reason is not null")
        if seen["dead"]:
            batches.write_batch(bad.select("line", "reason"), tables.dead_path, batch, run)
        good = rows.filter("reason is null")
        events = recent.batch_events(good)
        tables.ratings.append(events, batch, run)
        if batch > tables.lists.manifest()["applied"].get(str(run), -1):
            small = seen["ratings"] <= online.SMALL_BATCH
            mine = materialize(tables.ratings.lookup(events, few=small), "rated")
            kept = recent.recent_lists(good)
            # Users that the state may have forgotten: their recent ratings are among all of theirs.
            forgotten = kept.filter(~F.col("whole")).select("userId").distinct()
            newest = kept.filter("whole").select(*recent.RATING).unionByName(mine.join(forgotten, "userId", "left_semi").select(*recent.RATING))
            lists = online.recommend(events, mine, ranked, recent=newest, counts=seen, **parameters)
            if merge:
                lists = materialize(lists, "new-lists")
                lists = online.merge_with_old(lists, tables.lists.lookup(lists, few=small))
            tables.lists.replace(materialize(lists, "lists"), batch, run)
        if report:
            report(batch, seen)

    return update


def start_lists(
    messages: DataFrame, history: DataFrame, ranked: DataFrame, tables: OnlineTables, checkpoint: str,
    available_now: bool = False, recent_k: int = settings.RECENT_COUNT, expiry_ms: int = 0, **parameters,
) -> StreamingQuery:
    """Keep per-user lists current from a stream of rating messages.

    ``history`` is read by the first start over ``tables`` only: all of it goes into their ratings and each
    user's newest into the state. Bad messages go to the tables' dead letters out of the same micro-batch. A
    job with a new checkpoint over kept tables passes the tables' own ratings as ``history`` and ``run`` from
    ``tables.ratings.next_run()``.
    """
    tables.seed(history)
    seed = online.recent_ratings(history, recent_k).select(*recent.RATING)
    rows = sorted_messages(messages)
    good = rows.filter("reason is null").select(*recent.RATING)
    bad = rows.filter("reason is not null").select("line", "reason")
    output = recent.with_recent(good, seed, recent_k, expiry_ms).unionByName(bad, allowMissingColumns=True)
    action = update_tables(tables, ranked, recent_k=recent_k, **parameters)
    writer = output.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"availableNow": True} if available_now else {"processingTime": settings.MICRO_BATCH}
    with _session(messages.sparkSession, {
        "spark.sql.streaming.stateStore.providerClass": ROCKS,
        # State that expires would call for batches without data, of which there is no last one.
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }):
        return writer.trigger(**trigger).start()


@contextmanager
def _session(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for what starts inside; a stream keeps those it started with."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
