"""Near-duplicate groups and benchmark items against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfwise.llm import decontamination, minhash, queries
from shelfwise.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def check_components(out, texts):
    expected = brute_components(texts)
    rows = out.collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert (row["n_shingles"], row["component_id"]) == expected[row["doc_id"]]
        assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_groups_of_documents(spark, base, texts):
    check_components(queries.op10_circulant_minhash(spark, base), texts)


@pytest.fixture
def knot():
    """Copies of copies, each with a few other words, beside exact copies and short texts."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    made = [[word() for _ in range(150)]]
    for _ in range(120):
        copy = list(rng.choice(made))
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(len(copy))] = word()
        made.append(copy)
    lines = [" ".join(w) for w in made] + [" ".join(made[7]).upper()] * 3 + ["A b", "a B", "", " "]
    return dict(enumerate(lines))


@pytest.mark.parametrize("small", [2, 24, 1000])
def test_knot_of_near_copies(spark, knot, small, monkeypatch):
    """The same components whichever way buckets are compared."""
    monkeypatch.setattr(minhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 3000)
    docs = spark.createDataFrame(list(knot.items()), "doc_id bigint, text string")
    check_components(minhash.near_duplicates(docs), knot)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[1000:])
    agreed = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(agreed - 1 / 3) < 0.1


def test_awkward_groups(awkward, nothing):
    rows = minhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    assert [r["kept"] for r in rows if r["doc_id"] is None] == [True]
    assert all(r["component_id"] == r["doc_id"] for r in rows if r["doc_id"] is not None)
    assert minhash.near_duplicates(nothing).count() == 0


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 200)]
    found = dict(connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200}


def test_items_in_documents(spark, base, texts):
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{base}/benchmark.parquet").collect()}
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    index, sizes = defaultdict(set), Counter()
    for item, text in bench.items():
        words = cut(text)
        width = min(10, len(words))
        sizes[item] = len(words) - width + 1
        for j in range(sizes[item]):
            index[tuple(words[j : j + width])].add((item, j))
    expected = set()
    for doc, text in texts.items():
        words, hit = cut(text), defaultdict(set)
        for width in {len(k) for k in index}:
            for j in range(len(words) - width + 1):
                for item, place in index.get(tuple(words[j : j + width]), ()):
                    hit[item].add(place)
        expected |= {(doc, item) for item, places in hit.items() if 100 * len(places) >= 40 * sizes[item]}
    found = queries.op4_template_decontamination(spark, base).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected and expected


ITEM = "On Monday the farmer Miller sold 12 kg of apples for 30 dollars and then 12 kg of pears for 45 dollars to the teacher"


def contaminated(spark, docs):
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "Two words"), (7, ITEM)], "item_id bigint, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items).collect()}


def test_reparameterised_items(spark):
    other = ITEM.replace("12 kg", "7 miles").replace("30", "99").replace("dollars", "euros").replace("45", "8").replace("Miller", "Schmidt")
    uneven = ITEM.replace("12 kg of apples", "7 kg of apples")
    docs = ["x " + ITEM.upper() + " y", "Before. " + other, "It is " + uneven, "the farmer sold apples and pears to the teacher", "so two *** WORDS here", None, ""]
    assert contaminated(spark, docs) == {(0, 7), (1, 7), (4, 9)}


def test_awkward_contamination(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "one two three four five")], "item_id bigint, text string")
    found = decontamination.contaminated(awkward, items).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(4, 1)]
    assert decontamination.contaminated(nothing, items).count() == 0
    assert decontamination.contaminated(awkward, items.filter("false")).count() == 0
