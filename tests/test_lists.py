"""The online job on kept state: same lists as one event after another, without reading the past again."""

from __future__ import annotations

import math
import shutil
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from test_online import as_lists, direct, random_case, ranked_table

from shelfwise import schemas, settings
from shelfwise.plans import online
from shelfwise.session import fresh_path
from shelfwise.sources import batches, streams
from shelfwise.sources.keyed import KeyedTable
from shelfwise.streaming import lists as list_stream
from shelfwise.streaming import ratings as rating_stream
from shelfwise.streaming.recent import RecentRatings, newest


class Job:
    """A stream of text lines into tables of its own."""

    def __init__(self, spark, sims, history, **parameters):
        self.spark, self.ranked, self.parameters = spark, ranked_table(spark, sims), parameters
        self.source, self.checkpoint = fresh_path(spark, "test-source"), fresh_path(spark, "test-checkpoint")
        self.history_path = fresh_path(spark, "test-history")
        spark.createDataFrame(history, schemas.RATING).write.parquet(self.history_path)
        self.tables = list_stream.OnlineTables(spark, fresh_path(spark, "test-tables"), buckets=4)

    def arrive(self, rows):
        lines = [("|".join(str(v) for v in row) if isinstance(row, tuple) else row,) for row in rows]
        self.spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(self.source)

    def start(self, history=None, available_now=True):
        history = self.spark.read.schema(schemas.RATING).parquet(self.history_path) if history is None else history
        return list_stream.start_lists(
            streams.read_lines(self.spark, path=self.source), history, self.ranked, self.tables,
            self.checkpoint, available_now=available_now, **self.parameters,
        )

    def run(self):
        self.start().awaitTermination()
        return as_lists(self.tables.lists.snapshot())


def test_lists_of_two_runs_and_a_restart(spark):
    events, history, sims = random_case(6)
    job = Job(spark, sims, history)
    first, second = events[:50], events[50:]
    job.arrive(first)
    expected = direct(first, history + first, sims)
    assert job.run() == expected
    version = job.tables.lists.manifest()["version"]
    assert job.run() == expected and job.tables.lists.manifest()["version"] == version
    job.arrive(second)
    expected |= direct(second, history + first + second, sims)
    assert job.run() == expected
    assert job.tables.ratings.snapshot().count() == len(history) + len(events)


def test_history_is_not_read_after_the_first_batch(spark):
    events, history, sims = random_case(9)
    job = Job(spark, sims, history)
    first, second = events[:40], events[40:]
    job.arrive(first)
    query = job.start(available_now=False)
    try:
        query.processAllAvailable()
        expected = direct(first, history + first, sims)
        assert as_lists(job.tables.lists.snapshot()) == expected
        shutil.rmtree(job.history_path.removeprefix("file:"))
        job.arrive(second)
        query.processAllAvailable()
        assert as_lists(job.tables.lists.snapshot()) == expected | direct(second, history + first + second, sims)
    finally:
        query.stop()


def test_old_and_late_ratings_keep_their_order(spark):
    sims = {(a, b): 0.5 + (a + b) / 1000 for a in range(60) for b in range(60) if a != b}
    history = [(1, p, 4.0, 100 + p) for p in range(30)]
    job = Job(spark, sims, history)
    late = [(1, 40, 1.0, 50), (1, 41, 5.0, 129), (1, 42, 2.0, 500)]
    job.arrive(late)
    assert job.run() == direct(late, history + late, sims)
    later = [(1, 43, 2.0, 128), (1, 44, 3.0, 600), (2, 3, 3.0, 1)]
    job.arrive(later)
    assert job.run() == direct(later, history + late + later, sims)


def test_forgotten_users_get_whole_lists(spark):
    events, history, sims = random_case(12)
    job = Job(spark, sims, history, expiry_ms=1)
    first, second = events[:50], events[50:]
    job.arrive(first)
    expected = direct(first, history + first, sims)
    assert job.run() == expected
    time.sleep(0.1)
    job.arrive(second)
    assert job.run() == expected | direct(second, history + first + second, sims)


def test_bad_messages_go_to_dead_letters(spark):
    events, history, sims = random_case(3)
    counted = []
    job = Job(spark, sims, history, report=lambda batch, seen: counted.append(dict(seen)))
    bad = ["x|1|2.0|3", "1|1|2.0", "", "1|1|?|3", "4|17|5.0|2024-01-01"]
    job.arrive([*events, *bad])
    expected = direct(events, history + events, sims)
    assert job.run() == expected
    dead = sorted((row.line, row.reason) for row in job.tables.dead_letters().collect())
    assert dead == sorted([
        ("x|1|2.0|3", "userId is not a valid int"), ("1|1|2.0", "timestamp is not a valid int"), ("", "userId is not a valid int"),
        ("1|1|?|3", "score is not a valid double"), ("4|17|5.0|2024-01-01", "timestamp is not a valid int"),
    ])
    users = len({e[0] for e in events})
    assert counted == [{"ratings": len(events), "dead": 5, "users": users, "skipped": users - len(expected)}]
    job.arrive(["only bad"])
    assert job.run() == expected and job.tables.dead_letters().count() == 6


def test_messages_without_a_value_are_dead(spark):
    rows = rating_stream.sorted_messages(spark.createDataFrame([(None,), ("1|1|2.0|3",)], "value string"))
    job = Job(spark, {(1, 2): 0.9, (2, 1): 0.9}, [])
    assert job.tables.dead_letters().count() == 0
    seen = []
    output = rows.filter("reason is null").select(*schemas.RATING.names).withColumns({"rank": F.lit(None).cast("int"), "whole": F.lit(True)})
    ranked = output.withColumn("rank", F.lit(1))
    batch = output.unionByName(ranked).unionByName(rows.filter("reason is not null").select("line", "reason"), allowMissingColumns=True)
    list_stream.update_tables(job.tables, job.ranked, report=lambda _, counts: seen.append(counts))(batch, 0)
    assert [tuple(r)[:2] for r in job.tables.dead_letters().collect()] == [(None, "userId is not a valid int")]
    assert seen == [{"ratings": 1, "dead": 1, "users": 1, "skipped": 0}] and as_lists(job.tables.lists.snapshot()) == {1: [(2, pytest.approx(1.8))]}


def test_job_lost_between_two_writes_goes_on(spark, monkeypatch):
    events, history, sims = random_case(5)
    job = Job(spark, sims, history)
    job.arrive([*events, "bad"])

    def lost(*_, **__):
        raise OSError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(job.tables.lists, "replace", lost)
        with pytest.raises(Exception):
            job.run()
    assert job.tables.ratings.snapshot().count() == len(history) + len(events)
    assert job.run() == direct(events, history + events, sims)
    assert job.tables.ratings.snapshot().count() == len(history) + len(events)
    assert job.tables.dead_letters().count() == 1


def merged(old, new, n=20):
    """Both lists of a user, the higher score of each product."""
    best = {}
    for product, score in [*old, *new]:
        score = score.expected if hasattr(score, "expected") else score
        best[product] = max(best.get(product, score), score)
    order = sorted(best.items(), key=lambda x: (-math.floor(x[1] * 1e9 + 0.5), x[0]))[:n]
    return [(product, pytest.approx(score)) for product, score in order]


def test_merge_keeps_what_is_better_in_old_lists(spark):
    events, history, sims = random_case(2)
    job = Job(spark, sims, history, merge=True)
    expected, known = {}, list(history)
    for part in (events[:30], events[30:60], events[60:]):
        job.arrive(part)
        known += part
        for user, new in direct(part, known, sims).items():
            expected[user] = merged(expected.get(user, []), new)
        assert job.run() == expected
    assert any(len(own) == 20 for own in expected.values())


def test_merge_of_users_without_old_or_with_empty_lists(spark):
    lists = lambda rows: spark.createDataFrame(rows, schemas.USER_LIST)
    old = lists([(1, [(5, 1.0), (6, 0.5)]), (2, [(7, 1.0)]), (9, [(1, 1.0)])])
    new = lists([(1, [(6, 0.9), (8, 0.7)]), (2, []), (3, [(4, 0.2)]), (4, [])])
    found = as_lists(online.merge_with_old(new, old, n=2))
    assert found == {1: [(5, 1.0), (6, 0.9)], 2: [(7, 1.0)], 3: [(4, 0.2)], 4: []}


def test_route_messages_twice_adds_nothing(spark):
    good, bad = fresh_path(spark, "test-good"), fresh_path(spark, "test-bad")
    rows = rating_stream.sorted_messages(spark.createDataFrame([("1|2|3.0|4",), ("1|2",), (None,)], "value string"))
    for _ in range(2):
        rating_stream.route_messages(good, bad)(rows, 0)
    assert [tuple(r)[:4] for r in batches.read_batches(spark, good, schemas.RATING).collect()] == [(1, 2, 3.0, 4)]
    dead = batches.read_batches(spark, bad, list_stream.DEAD).collect()
    assert {(r.line, r.reason) for r in dead} == {("1|2", "score is not a valid double"), (None, "userId is not a valid int")}


def test_counts_come_with_the_lists(spark):
    counts = {}
    ranked = ranked_table(spark, {(1, 2): 0.9, (2, 1): 0.9})
    empty = spark.createDataFrame([], schemas.RATING)
    assert online.recommend(empty, empty, ranked, counts=counts).count() == 0
    assert counts == {"users": 0, "skipped": 0}


def test_newest_order_is_that_of_the_table_form(spark):
    rows = [(1, p, float(s), t) for p in range(5) for s in (1, 2) for t in (7, 8)]
    frame = online.recent_ratings(spark.createDataFrame(rows, schemas.RATING), 9).orderBy("rank")
    assert [(r.productId, r.score, r.timestamp) for r in frame.collect()] == newest([r[1:] for r in rows], 9)
    assert settings.RECENT_COUNT == 21 and KeyedTable is type(list_stream.OnlineTables(spark, "/tmp/none").lists)


def test_a_user_of_the_seed_takes_one_call_on_the_state():
    calls = []

    class State:
        def get(self):
            calls.append("get")

        def update(self, value):
            calls.append(value)

    processor = RecentRatings(2)
    processor.recent = State()
    processor.handleInitialState((7,), Row(userId=7, products=[1, 2, 3], scores=[4.0, 5.0, 1.0], timestamps=[10, 30, 20]), None)
    assert calls == [([2, 3], [5.0, 1.0], [30, 20], True)]
