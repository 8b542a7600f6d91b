"""The near-duplicate stage of the pipeline against brute force at its threshold."""

from __future__ import annotations

import random

import corpus_pipeline
from shelfwise.llm import minhash


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_stage_links_from_080_on(spark):
    """One changed word of 48, 49 or 54 gives a similarity of 39/49, 40/50 or 45/55."""
    rng = random.Random(8)
    texts = []
    for size in (48, 49, 54):
        for _ in range(40):
            words = [f"w{rng.randint(0, 10**9)}" for _ in range(size)]
            texts += [" ".join(words), " ".join([*words[:20], "other", *words[21:]])]
    kept = set(range(len(texts)))
    for a in range(0, len(texts), 2):
        one, two = shingles(texts[a]), shingles(texts[a + 1])
        if 100 * len(one & two) >= 80 * len(one | two):
            kept.discard(a + 1)
    assert len(kept) == len(texts) - 80
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert {r["doc_id"] for r in out.collect()} == kept


def test_limits_follow_the_threshold():
    assert minhash.banding(85) == (48, 8)
    for percent in (50, 80, 85, 95, 100):
        bands, rows = minhash.banding(percent)
        assert (1 - (min(percent, 99) / 100) ** rows) ** bands <= minhash.MISSED
    assert minhash.most_distance(80) > minhash.most_distance(85) > minhash.most_distance(95)
