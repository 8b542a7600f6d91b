"""Online recommendations, in batch and as a stream."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas, settings
from shelfwise.operators.topn import rank_lists
from shelfwise.plans import online
from shelfwise.session import fresh_path
from shelfwise.sources import batches, streams
from shelfwise.sources.tables import materialize
from shelfwise.streaming import ratings as rating_stream


def ranked_table(spark, sims: dict):
    rows = [(a, b, score) for (a, b), score in sims.items()]
    return materialize(rank_lists(spark.createDataFrame(rows, schemas.PAIR)), "test-sims")


def direct(events: list, history: list, sims: dict) -> dict[int, list]:
    """One event after another, as the definition says."""
    lists = defaultdict(list)
    for (a, b), score in sims.items():
        lists[a].append((-score, b))
    newest = {}
    for event in sorted(events, key=lambda e: (e[3], -e[1], e[2])):
        newest[event[0]] = event
    result = {}
    for user, product, _, _ in newest.values():
        if product not in lists:
            continue
        rated = {p for u, p, _, _ in history if u == user}
        near = [b for _, b in sorted(lists[product]) if b not in rated][:20]
        mine = sorted((h for h in history if h[0] == user), key=lambda h: (-h[3], h[1], -h[2]))[:21]
        scored = []
        for candidate in near:
            met = [(sims[candidate, p], s) for _, p, s, _ in mine if sims.get((candidate, p), 0) > 0.4]
            if met:
                ups = sum(s > 3 for _, s in met)
                mean = sum(sim * s for sim, s in met) / len(met)
                scored.append(
                    (mean + math.log10(max(ups, 1)) - math.log10(max(len(met) - ups, 1)), candidate)
                )
        scored.sort(key=lambda x: (-math.floor(x[0] * 1e9 + 0.5), x[1]))
        result[user] = [(b, pytest.approx(score)) for score, b in scored]
    return result


def as_lists(frame) -> dict[int, list]:
    return {r["userId"]: [(x["productId"], x["score"]) for x in r["recs"]] for r in frame.collect()}


def random_case(seed: int):
    random.seed(seed)
    sims = {}
    for a in range(80):
        for b in range(a):
            if random.random() < 0.6:
                sims[a, b] = sims[b, a] = round(random.uniform(0.3, 1.0), 3)
    history = [
        (random.randrange(30), random.randrange(80), float(random.randint(1, 5)), random.randrange(1000))
        for _ in range(900)
    ]
    # User 0 has rated most products; every third event is on product 7.
    history += [(0, p, 4.0, p) for p in range(60)]
    events = [
        (user, 7 if user % 3 == 0 else random.randrange(90), float(random.randint(1, 5)), 2000 + t)
        for user in range(40)
        for t in range(2)
    ]
    return events, history, sims


@pytest.mark.parametrize("small_batch", [0, 80])
@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_batch_equals_one_event_after_another(spark, monkeypatch, hot_rows, small_batch):
    real = online.hot_keys
    monkeypatch.setattr(online, "hot_keys", lambda c, s, k: real(c, s, k, hot_rows))
    monkeypatch.setattr(online, "SMALL_BATCH", small_batch)
    monkeypatch.setattr(online, "SLICE", 8)
    events, history, sims = random_case(4)
    found = online.recommend(
        spark.createDataFrame(events, schemas.RATING),
        spark.createDataFrame(history, schemas.RATING),
        ranked_table(spark, sims),
    )
    assert as_lists(found) == direct(events, history, sims)


def test_unknown_product_and_empty_list(spark):
    sims = {(1, 2): 0.9, (2, 1): 0.9}
    ranked = ranked_table(spark, sims)
    events = spark.createDataFrame([(1, 1, 5.0, 9), (2, 77, 5.0, 9)], schemas.RATING)
    history = spark.createDataFrame([(1, 50, 5.0, 1)], schemas.RATING)
    assert as_lists(online.recommend(events, history, ranked)) == {1: []}
    assert [r["userId"] for r in online.skipped_events(events, ranked).collect()] == [2]


def test_recent_count_includes_both_ends(spark):
    rows = [(1, p, 1.0, p) for p in range(40)]
    recent = online.recent_ratings(spark.createDataFrame(rows, schemas.RATING)).orderBy("rank")
    assert [r["productId"] for r in recent.collect()] == list(range(39, 18, -1))
    assert settings.RECENT_COUNT == 21


def test_pair_similarity_defaults_to_zero(spark):
    pairs = spark.createDataFrame([(1, 2, 0.5)], schemas.PAIR)
    wanted = spark.createDataFrame([(1, 2), (2, 1)], "productId int, recProductId int")
    found = online.pair_similarity(wanted, pairs).collect()
    assert {(r["productId"], r["score"]) for r in found} == {(1, 0.5), (2, 0.0)}


def test_log_lines(spark):
    values = [
        "INFO PRODUCT_RATING_PREFIX: 4|17|5.0|13 ",
        "no prefix 4|17|5.0|13",
        "ends with PRODUCT_RATING_PREFIX:",
        "PRODUCT_RATING_PREFIX:1|2|3.0|4PRODUCT_RATING_PREFIX:5|6|1.0|2",
    ]
    lines = spark.createDataFrame([(v,) for v in values], "value string")
    messages = rating_stream.rating_messages(lines)
    assert [tuple(r) for r in messages.collect()] == [("4", "4|17|5.0|13"), ("1", "1|2|3.0|4")]
    assert [tuple(r) for r in rating_stream.rating_events(messages).collect()] == [
        (4, 17, 5.0, 13), (1, 2, 3.0, 4)
    ]
    bad = spark.createDataFrame([("x|1|2.0|3",), ("1|1|2.0|3",)], "value string")
    assert rating_stream.rating_events(bad, strict=False).count() == 1


def test_broker_options():
    options = streams.topic_options("host:9092")
    assert options["subscribe"] == "recommender" and options["startingOffsets"] == "latest"


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    events, history, sims = random_case(6)
    ranked = ranked_table(spark, sims)
    base = spark.createDataFrame(history, schemas.RATING)
    source = fresh_path(spark, "test-source")
    history_path, lists_path = fresh_path(spark, "test-history"), fresh_path(spark, "test-lists")
    checkpoint = fresh_path(spark, "test-checkpoint")

    def run():
        lines = streams.read_lines(spark, path=source)
        rating_stream.start_lists(
            rating_stream.rating_events(lines), base, ranked, history_path, lists_path,
            checkpoint, available_now=True,
        ).awaitTermination()
        return batches.read_batches(spark, lists_path, schemas.USER_LIST)

    def arrive(rows):
        text = [("|".join(str(v) for v in row),) for row in rows]
        spark.createDataFrame(text, "value string").coalesce(1).write.mode("append").text(source)

    first, second = events[:50], events[50:]
    arrive(first)
    stored = run()
    expected = direct(first, history + first, sims)
    assert as_lists(batches.latest(stored, "userId")) == expected

    assert run().count() == stored.count()

    arrive(second)
    expected |= direct(second, history + first + second, sims)
    stored = run()
    assert as_lists(batches.latest(stored, "userId")) == expected

    compacted = fresh_path(spark, "test-compacted")
    batches.compact(spark, lists_path, schemas.USER_LIST, "userId", compacted)
    assert as_lists(batches.latest(batches.read_batches(spark, compacted, schemas.USER_LIST), "userId")) == expected


def test_new_checkpoint_over_a_compacted_table_loses_nothing(spark):
    path, into = fresh_path(spark, "test-batches"), fresh_path(spark, "test-base")
    old = spark.createDataFrame([(1, 5, 3.0, 1), (2, 6, 4.0, 2)], schemas.RATING)
    batches.write_batch(old, path, 0)
    batches.write_batch(old, path, 7)
    batches.compact(spark, path, schemas.RATING, "userId", into, newest_only=False)
    assert batches.next_run(spark, path) == 2 and batches.next_run(spark, into) == 1
    assert batches.next_run(spark, fresh_path(spark, "test-none")) == 1
    new = spark.createDataFrame([(1, 9, 5.0, 3)], schemas.RATING)
    batches.write_batch(new, into, 0, batches.next_run(spark, into))
    stored = batches.read_batches(spark, into, schemas.RATING)
    assert stored.count() == 5
    assert {r["userId"]: r["productId"] for r in batches.latest(stored, "userId").collect()} == {1: 9, 2: 6}
    with pytest.raises(ValueError):
        batches.write_batch(new, into, 0, batches.BASE_RUN)


def test_small_batch_does_not_shuffle_the_large_tables(spark):
    events, history, sims = random_case(8)
    ranked = ranked_table(spark, sims)
    path = fresh_path(spark, "test-history-table")
    spark.createDataFrame(history, schemas.RATING).write.parquet(path)
    table = spark.read.schema(schemas.RATING).parquet(path)
    current = online.newest_events(spark.createDataFrame(events, schemas.RATING))
    near = online.only(ranked, current, "productId", small=True)
    current = online.known_events(current, near, small=True)
    chosen = online.candidates(current, table, near, small=True)
    stored = spark.createDataFrame(chosen.collect(), chosen.schema)
    for frame in (chosen, online.scores(stored, table, ranked, small=True)):
        lines = frame._jdf.queryExecution().sparkPlan().toString().splitlines()
        scans = [i for i, line in enumerate(lines) if "FileScan" in line]
        assert scans
        for i in scans:
            above = [line for line in lines[max(0, i - 4) : i] if "Join" in line]
            assert above and "BroadcastHashJoin" in above[-1], "\n".join(lines[max(0, i - 4) : i + 1])


def test_replayed_batch_changes_nothing(spark):
    events, history, sims = random_case(7)
    ranked = ranked_table(spark, sims)
    base = spark.createDataFrame(history, schemas.RATING)
    frame = spark.createDataFrame(events, schemas.RATING)
    history_path, lists_path = fresh_path(spark, "test-history"), fresh_path(spark, "test-lists")
    skipped = []
    update = rating_stream.update_lists(
        base, ranked, history_path, lists_path, report=lambda batch, n: skipped.append(n)
    )
    results = []
    for _ in range(2):
        update(frame, 0)
        stored = batches.read_batches(spark, lists_path, schemas.USER_LIST)
        results.append(as_lists(batches.latest(stored, "userId")))
    assert results[0] == results[1] == direct(events, history + events, sims)
    assert skipped == [len({e[0] for e in events}) - len(results[0])] * 2 and skipped[0] > 0
    assert batches.read_batches(spark, history_path, schemas.RATING).filter(F.col("batch") == 0).count() == len(events)
