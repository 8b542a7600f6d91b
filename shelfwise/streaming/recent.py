"""The newest ratings of each user as stream state."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

# Workers get the processor with the plan, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RATING = ["userId", "productId", "score", "timestamp"]
#: What leaves a micro-batch: its ratings, with a null ``rank``, and of each user in it the
#: newest ratings of all time, ranked from 1. ``whole`` says that none can be missing before them.
OUTPUT = "userId int, productId int, score double, timestamp int, rank int, whole boolean"
STATE = "products array<int>, scores array<double>, timestamps array<int>, whole boolean"

Held = list[tuple[int, float, int]]


def newest(ratings: Held, k: int) -> Held:
    """The ``k`` newest (product, score, timestamp); of equal times the smaller product, then the better score."""
    return sorted(ratings, key=lambda r: (-r[2], r[0], -r[1]))[:k]


class RecentRatings(StatefulProcessor):
    """Holds at most ``k`` ratings a user, whatever their number, and forgets a user ``expiry_ms``
    after the last rating (0: never)."""

    def __init__(self, k: int, expiry_ms: int = 0):
        self.k, self.expiry_ms = k, expiry_ms

    def init(self, handle) -> None:
        lasting = {"ttlDurationMs": self.expiry_ms} if self.expiry_ms else {}
        self.recent = handle.getValueState("recent", STATE, **lasting)

    def handleInitialState(self, key, initial_state, timer_values) -> None:
        # One row a user holds all: each call on the state is a message to the server beside the worker.
        rows = [initial_state] if isinstance(initial_state, Row) else initial_state
        self._store([rating for row in rows for rating in zip(row.products, row.scores, row.timestamps)], True)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        held, whole = self._held()
        new: Held = []
        for row in rows:
            yield Row(userId=key[0], productId=row.productId, score=row.score, timestamp=row.timestamp, rank=None, whole=whole)
            new.append((row.productId, row.score, row.timestamp))
            if len(new) > 50 * self.k:
                new = newest(new, self.k)
        held = self._store([*held, *new], whole)
        for rank, (product, score, timestamp) in enumerate(held, 1):
            yield Row(userId=key[0], productId=product, score=score, timestamp=timestamp, rank=rank, whole=whole)

    def _held(self) -> tuple[Held, bool]:
        """The stored ratings. Where users are forgotten, one without any may have been."""
        state = self.recent.get()
        if state is None:
            return [], not self.expiry_ms
        return list(zip(*state[:3])), state[3]

    def _store(self, ratings: Held, whole: bool) -> Held:
        held = newest(ratings, self.k)
        self.recent.update((*([r[i] for r in held] for i in range(3)), whole))
        return held

    def close(self) -> None:
        pass


def with_recent(events: DataFrame, seed: DataFrame | None, k: int, expiry_ms: int = 0) -> DataFrame:
    """A stream of ratings with every micro-batch followed by its users' ``k`` newest ratings: ``OUTPUT``.

    ``seed`` are ratings of before the stream, at most ``k`` newest of each user; they are
    read by the first micro-batch only. Needs the RocksDB state store.
    """
    if seed is not None:
        packed = seed.groupBy("userId").agg(F.collect_list(F.struct(*RATING[1:])).alias("held"))
        names = zip(RATING[1:], ("products", "scores", "timestamps"))
        seed = packed.select("userId", *(F.col(f"held.{field}").alias(name) for field, name in names)).groupBy("userId")
    return events.groupBy("userId").transformWithState(
        RecentRatings(k, expiry_ms), OUTPUT, "append", "processingTime" if expiry_ms else "none", initialState=seed
    )


def batch_events(output: DataFrame) -> DataFrame:
    """The micro-batch's own ratings."""
    return output.filter("rank is null").select(*RATING)


def recent_lists(output: DataFrame) -> DataFrame:
    """The newest ratings of the micro-batch's users, with their rank."""
    return output.filter(F.col("rank").isNotNull())
