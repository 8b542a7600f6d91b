"""Documents of several rows: an id with different texts is linked by each of them."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest

from shelfwise.llm import minhash

SCHEMA = "doc_id bigint, text string"


def shingles(text):
    words = (text or "").lower().split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def brute(rows, percent):
    """(doc_id, n_shingles, component) per row, ids of one document being one node."""
    sets = [shingles(text) for _, text in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(zip([i for i, _ in rows], sets), 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets))


def found(spark, rows, percent):
    out = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent).collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in out)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in out)


def text(rng, n=60):
    return " ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), k=n))


def test_both_texts_of_an_id_link_it(spark):
    rng = random.Random(1)
    a, b = text(rng), text(rng)
    rows = [(5, a), (5, b), (6, a + " x"), (7, b + " y"), (8, text(rng))]
    assert found(spark, rows, 85) == brute(rows, 85)
    assert {r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows[:4], SCHEMA)).collect()} == {5}


@pytest.mark.parametrize("percent", [80, 85])
def test_random_tables_with_repeated_ids(spark, percent):
    rng = random.Random(percent)
    stems = [text(rng, 80) for _ in range(12)]
    rows = [(None, stems[0]), (None, ""), (3, None), (3, stems[3]), (4, "one two"), (9, "one two"), (9, "three")]
    for _ in range(70):
        words = rng.choice(stems).split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(["x", "y", "z"])
        rows.append((rng.randrange(40), " ".join(words)))
    rows += rows[:5]
    assert found(spark, rows, percent) == brute(rows, percent)


def planted_pairs(rng, percent):
    """Two texts whose sets have a similarity of just ``percent`` or a little more."""
    words = [f"{rng.randrange(10**6)}" for _ in range(204)]
    # A changed word takes five shingles of 200 away on either side: 200 - 5k of 200 + 5k are shared.
    changes = max(k for k in range(1, 10) if 100 * (200 - 5 * k) >= percent * (200 + 5 * k))
    other = list(words)
    for k in range(changes):
        other[10 + 20 * k] = f"new{rng.randrange(10**6)}"
    return " ".join(words), " ".join(other)


@pytest.mark.parametrize("percent", [80, 85])
def test_recall_of_planted_pairs_at_the_threshold(spark, percent):
    rng = random.Random(percent)
    rows = [(2 * i + side, t) for i in range(400) for side, t in enumerate(planted_pairs(rng, percent))]
    out = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent).collect()
    assert sum(r.component_id == r.doc_id - r.doc_id % 2 for r in out) == len(rows)
