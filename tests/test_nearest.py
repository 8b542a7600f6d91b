"""Heads of lists and single scores from vectors, against brute force."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import nearest
from shelfwise.operators.topn import rank_lists
from shelfwise.plans import content, online
from shelfwise.sources.tables import materialize


@pytest.fixture(scope="module")
def case(spark):
    random.seed(11)
    rows = []
    for i in range(240):
        tags = [f"{kind}{random.randrange(size)}" for kind, size in (("a", 3), ("b", 4), ("c", 5), ("d", 9))]
        rows.append((1000 - 3 * i, "n", "", "", "|".join(tags[: random.choice([2, 4, 4, 4])])))
    rows.append((5000, "n", "", "", "alone"))
    products = materialize(spark.createDataFrame(rows, schemas.PRODUCT), "test-products")
    ranked = materialize(rank_lists(content.content_sims(products)), "test-ranked")
    history = [(u, rows[random.randrange(len(rows))][0], float(random.randint(1, 5)), t) for u in range(40) for t in range(25)]
    history = materialize(spark.createDataFrame(history, schemas.RATING), "test-history")
    return products, ranked, history


def test_online_steps_need_no_table_of_links(case):
    products, ranked, history = case
    kept = content.content_lists(products)
    events = online.newest_events(history)
    found = [materialize(online.known_events(events, known), "test-events") for known in (kept, ranked)]
    names = ["userId", "productId", "score", "timestamp"]
    assert sorted(found[0].select(names).collect()) == sorted(found[1].select(names).collect())
    chosen = [materialize(online.candidates(found[1], history, known), "test-candidates") for known in (kept, ranked)]
    rows = [{(r["userId"], r["rank"]): (r["recProductId"], round(r["score"], 9)) for r in x.collect()} for x in chosen]
    assert rows[0] == rows[1] and rows[0]
    scores = [online.scores(chosen[1], history, known).collect() for known in (kept, ranked)]
    scores = [{(r["userId"], r["recProductId"]): round(r["score"], 8) for r in x} for x in scores]
    assert scores[0] == scores[1] and scores[0]
    wanted = events.select("userId", "productId").join(history.select("userId", F.col("productId").alias("recProductId")), "userId")
    pairs = [online.pair_similarity(wanted, known).select("userId", "productId", "recProductId", F.round("score", 9)) for known in (kept, ranked)]
    pairs = [sorted(map(tuple, x.collect())) for x in pairs]
    assert pairs[0] == pairs[1]
    assert "links" not in vars(kept)


def test_wide_users_meet_heads_as_rows(case, monkeypatch):
    products, ranked, history = case
    kept = content.content_lists(products)
    events = materialize(online.known_events(online.newest_events(history), ranked), "test-events")

    def chosen():
        found = online.candidates(events, history, kept).select("userId", "rank", "recProductId", F.round("score", 9))
        return sorted(map(tuple, found.collect()))

    expected = chosen()
    monkeypatch.setattr(online, "RATED_ROW", 23)
    assert chosen() == expected


def test_levels_give_what_the_threshold_gives(case, monkeypatch):
    products, ranked, _ = case
    vectors = content.content_lists(products).vectors
    wanted = vectors.select("id", (F.col("id") % 60 + 1).alias("need"))
    monkeypatch.setattr(nearest, "CHUNK", 50)

    def rows(levels):
        return sorted((r["a"], r["b"], r["order_key"], r["before"]) for r in nearest.nearest(vectors, wanted, 0.4, levels).collect())

    assert rows((0.9, 0.6, 0.3, 0.0)) == rows((0.0,))
    lengths = {r["productId"]: r["length"] for r in ranked.select("productId", "length").distinct().collect()}
    assert {r[0] for r in rows((0.0,))} == set(lengths) & {r["id"] for r in wanted.collect()}


def test_stored_intermediates_leave_no_shuffle_files(spark):
    def files() -> set[str]:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x.getName() for x in (found.apply(i) for i in range(found.size())) if x.getName().startswith("shuffle_")}

    before = files()
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(materialize(counts.repartition(3, "count"), "test-counts").collect()) == 7
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
