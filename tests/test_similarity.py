"""Pair kernels, copies and ranked lists against direct computation."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from shelfwise import settings
from shelfwise.operators import copies, cosine, skew, topn
from shelfwise.plans import content, factors
from shelfwise.sources.tables import list_pairs, materialize

PRODUCT = "productId int, name string, imageUrl string, categories string, tags string"


def pairs_of(frame) -> dict:
    rows = frame.collect()
    found = {(r["productId"], r["recProductId"]): r["score"] for r in rows}
    assert len(found) == len(rows), "a pair came out twice"
    return found


def direct_sims(tags: dict[int, str], threshold: float = 0.4) -> dict:
    words = {p: Counter(t.replace("|", " ").lower().split(" ")) for p, t in tags.items()}
    holders = Counter(w for counts in words.values() for w in counts)
    idf = {w: math.log((len(tags) + 1) / (n + 1)) for w, n in holders.items()}
    vectors = {p: {w: n * idf[w] for w, n in c.items() if idf[w]} for p, c in words.items()}
    norms = {p: math.sqrt(sum(x * x for x in v.values())) for p, v in vectors.items()}
    sims = {}
    for a in tags:
        for b in tags:
            if a != b and norms[a] and norms[b]:
                dot = sum(x * vectors[b].get(w, 0.0) for w, x in vectors[a].items())
                score = dot / (norms[a] * norms[b])
                if score > threshold:
                    sims[a, b] = pytest.approx(score)
    return sims


def product_frame(spark, tags: dict[int, str]):
    return spark.createDataFrame([(p, f"n{p}", "", "", t) for p, t in tags.items()], PRODUCT)


def random_tags(seed: int, n: int, copy_share: float) -> dict[int, str]:
    """Products with 1 to 6 tags of a skewed vocabulary; a share are plain copies."""
    random.seed(seed)
    vocabulary = [f"t{int(random.paretovariate(0.7))}" for _ in range(300)]
    tags = {}
    for product in range(n):
        if random.random() < copy_share:
            tags[product * 7] = "Red|mug||kitchen"
        else:
            tags[product * 7] = "|".join(random.choices(vocabulary, k=random.randint(1, 6)))
    return tags


@pytest.mark.parametrize("chunk_rows", [3, 1024])
def test_content_pairs_are_exact_with_a_third_of_copies(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(copies, "PART_IDS", 8)
    real = content.sparse_pairs
    monkeypatch.setattr(content, "sparse_pairs", lambda v, t: real(v, t, chunk_rows))
    tags = random_tags(5, 120, 0.33)
    assert pairs_of(content.content_sims(product_frame(spark, tags))) == direct_sims(tags)


def test_content_pairs_are_exact_with_hot_terms_and_groups(spark, monkeypatch):
    for module in (content, copies):
        monkeypatch.setattr(module, "hot_keys", lambda c, s, k: skew.hot_keys(c, s, k, 2))
    tags = random_tags(6, 60, 0.4)
    assert pairs_of(content.content_sims(product_frame(spark, tags))) == direct_sims(tags)


def test_product_of_common_tags_only_has_no_pairs(spark):
    tags = {1: "a", 2: "a", 3: "a|b", 4: "a|b", 5: "a|c"}
    found = pairs_of(content.content_sims(product_frame(spark, tags)))
    assert found == direct_sims(tags)
    assert set(found) == {(3, 4), (4, 3)}


def test_equal_words_in_other_order_and_case_are_copies(spark):
    found = pairs_of(content.content_sims(product_frame(spark, {1: "A|b", 2: "b|a", 3: "c"})))
    assert found == {(1, 2): 1.0, (2, 1): 1.0}


def test_exact_weights_equal_the_library_transformers(spark):
    products = product_frame(spark, random_tags(8, 40, 0.2))
    words = content.tag_documents(products)
    vectorizer = CountVectorizer(inputCol="words", outputCol="counts").fit(words)
    counts = vectorizer.transform(words)
    weights = IDF(inputCol="counts", outputCol="weights").fit(counts).transform(counts)
    vocabulary = vectorizer.vocabulary
    expected = {
        (r["id"], vocabulary[r["bucket"]]): pytest.approx(r["value"])
        for r in content.vector_entries(weights, "weights", ["id"]).collect()
    }
    found = {(r["productId"], r["term"]): r["weight"] for r in content.tfidf_weights(products).collect()}
    assert found == expected


def test_hashed_form_equals_the_exact_one_without_collisions(spark):
    products = product_frame(spark, {1: "red|mug", 2: "red|cup", 3: "blue|mug", 4: "red|mug|big", 5: "tea"})
    exact = pairs_of(content.content_sims(products))
    hashed = pairs_of(content.content_sims_hashed(products, buckets=1 << 18))
    assert hashed == {pair: pytest.approx(score) for pair, score in exact.items()}
    assert exact


@pytest.mark.parametrize("chunk_rows", [4, 4096])
def test_dense_pairs_are_exact_with_copies_and_zeros(spark, monkeypatch, chunk_rows):
    real = factors.dense_pairs
    monkeypatch.setattr(factors, "dense_pairs", lambda v, t: real(v, t, chunk_rows))
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(40, 4))
    matrix[5:18] = matrix[4]
    matrix[20] = 0.0
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(matrix)]
    found = pairs_of(factors.vector_sims(spark.createDataFrame(rows, "id int, vector array<double>")))
    expected = {}
    for a in range(40):
        for b in range(40):
            length = np.linalg.norm(matrix[a]) * np.linalg.norm(matrix[b])
            if a != b and length and matrix[a] @ matrix[b] / length > 0.4:
                expected[a, b] = pytest.approx(matrix[a] @ matrix[b] / length)
    assert found == expected
    assert all(0.4 < score <= 1 + 1e-9 for score in found.values())
    assert {(b, a) for a, b in found} == set(found)


def test_rare_terms_find_all_pairs_without_the_common_ones(spark):
    tags = random_tags(11, 80, 0.0)
    documents = content.tag_documents(product_frame(spark, tags)).withColumn("copies", F.lit(1).cast("long"))
    vectors = cosine.sparse_vectors(content.weighted_terms(documents), "id", "spread")
    searched = cosine.search_terms(vectors, 0.4).count()
    stored = vectors.agg(F.sum(F.size("terms"))).first()[0]
    assert searched < stored


def test_cosine_of_a_zero_vector_is_null(spark):
    frame = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    assert frame.select(cosine.cosine(F.col("a"), F.col("b")).alias("c")).first()["c"] is None


def test_lookup_join_with_hot_keys_keeps_all_rows(spark):
    left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    left = left.unionByName(spark.range(500).select(F.lit(3).cast("long").alias("k"), "id"))
    right = spark.range(6).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
    hot = skew.hot_keys(counts, "rows", ["k"], 300)
    assert [(row["k"], row["salts"]) for row in hot.collect()] == [(3, 3)]
    joined = skew.lookup_join(left, right, ["k"], hot)
    assert sorted(joined.collect()) == sorted(left.join(right, ["k"]).select(joined.columns).collect())


def test_every_key_may_be_hot(spark):
    left = spark.range(12000).select((F.col("id") % 6000).alias("k"), "id")
    right = spark.range(6000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
    hot = skew.hot_keys(counts, "rows", ["k"], 1)
    assert hot.count() == 6000 and skew.lookup_join(left, right, ["k"], hot).count() == 12000


def test_salted_join_keeps_all_rows(spark):
    left = spark.range(600).select((F.col("id") % 7).cast("int").alias("k"), F.lit(1).alias("s"), "id")
    right = spark.range(30).select((F.col("id") % 5).cast("int").alias("k"), F.lit(1).alias("s"), F.col("id").alias("v"))
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
    hot = skew.hot_keys(counts, "rows", ["k"], 10)
    assert hot.count() == 7
    joined = skew.salted_join(left, right, ["k", "s"], hot, ["id"])
    plain = left.join(right, ["k", "s"])
    assert sorted(joined.select(plain.columns).collect()) == sorted(plain.collect())


def test_ranks_of_long_lists_cross_partitions(spark):
    random.seed(2)
    rows = [(1, rec, round(random.random(), 2)) for rec in range(700)]
    rows += [(key, rec, random.random()) for key in range(2, 30) for rec in range(5)]
    pairs = spark.createDataFrame(rows, "productId int, recProductId int, score double")
    ranked = materialize(topn.rank_lists(pairs), "test-ranked")
    expected = defaultdict(list)
    for key, rec, score in sorted(rows, key=lambda r: (r[0], -r[2], r[1])):
        expected[key].append(rec)
    found = defaultdict(dict)
    for row in ranked.collect():
        found[row["productId"]][row["rank"]] = row["recProductId"]
    assert {k: [v[i + 1] for i in range(len(v))] for k, v in found.items()} == expected

    lists = topn.to_lists(ranked, part_rows=100)
    assert lists.agg(F.max(F.size("recs"))).first()[0] == 100
    assert lists.filter("productId = 1").count() == 7
    back = topn.to_ranked(lists, part_rows=100)
    assert sorted(back.collect()) == sorted(ranked.select(back.columns).collect())
    assert list_pairs(lists).count() == len(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(1, 9, 0.5), (1, 3, 0.5 + 1e-12), (1, 4, 0.7), (1, 2, 0.1)]
    pairs = spark.createDataFrame(rows, "productId int, recProductId int, score double")
    found = topn.top_scores(pairs, "productId", 3).orderBy("rank").collect()
    assert [r["recProductId"] for r in found] == [4, 3, 9]


def test_merge_keeps_the_higher_score(spark):
    schema = "userId int, recProductId int, score double"
    old = spark.createDataFrame([(1, 5, 0.9), (1, 6, 0.2), (2, 5, 0.3)], schema)
    new = spark.createDataFrame([(1, 5, 0.4), (1, 7, 0.5)], schema)
    found = topn.merge_lists(old, new, 2).collect()
    assert {(r["userId"], r["rank"], r["recProductId"], r["score"]) for r in found} == {
        (1, 1, 5, 0.9), (1, 2, 7, 0.5), (2, 1, 5, 0.3)
    }


def test_threshold_is_strict():
    assert settings.SIMILARITY_THRESHOLD == 0.4


def test_merged_lists_are_dealt_out_again(spark):
    """Lists that are cut per user already are not merged and cut once more in the same task."""
    nan, none = float("nan"), None
    rows = [(1, 1, 0.5), (1, 2, nan), (1, 3, none), (2, 1, 0.2), (none, 1, 0.1), (2, none, 0.4)]
    lists = [
        topn.top_scores(spark.createDataFrame(part, "userId int, recProductId int, score double"), "userId", 5)
        for part in (rows, [(1, 1, 0.7), (1, 2, 0.1), (1, 3, 0.3), (2, 1, 0.1), (none, 1, 0.3), (2, none, none)])
    ]
    merged = topn.merge_lists(*lists, 5)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "Exchange hashpartitioning(userId" in plan[: plan.index("Union")].rsplit("Window [", 1)[1]
    found = {(r["userId"], r["recProductId"]): r["score"] for r in merged.collect()}
    assert math.isnan(found.pop((1, 2)))
    assert found == {(1, 1): 0.7, (1, 3): 0.3, (2, 1): 0.2, (none, 1): 0.3, (2, none): 0.4}


def test_only_pairs_with_copies_are_stored(spark, monkeypatch):
    real, stored = factors.materialize, {}

    def store(frame, name):
        stored[name] = real(frame, name)
        return stored[name]

    monkeypatch.setattr(factors, "materialize", store)
    alone = [(i, [1.0, i / 100]) for i in range(30)]
    found = factors.vector_sims(spark.createDataFrame(alone, "id int, vector array<double>"))
    assert found.count() == 30 * 29 and "vector-pairs" not in stored
    copied = spark.createDataFrame([*alone, (30, alone[0][1])], "id int, vector array<double>")
    assert factors.vector_sims(copied).distinct().count() == 31 * 30
    assert stored["vector-pairs"].count() == 29
