"""Largest inner products, against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from shelfwise.operators.inner import best_items, best_of

SCHEMA = "id int, vector array<double>"


def vectors(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], SCHEMA).repartition(3)


def all_pairs(users, items, n):
    result = {}
    for user, x in enumerate(users):
        scored = [(float(np.dot(x, y)), item) for item, y in enumerate(items)]
        positive = [(math.floor(s * 1e9 + 0.5), item, s) for s, item in scored if s > 0]
        result[user] = [(item, pytest.approx(s)) for _, item, s in sorted(positive, key=lambda p: (-p[0], p[1]))[:n]]
    return result


def found(frame):
    return {row.id: [*zip(row.products, row.scores)] for row in frame.collect()}


CASES = {
    "falling norms": lambda rng: (rng.normal(size=(150, 6)), rng.normal(size=(400, 6)) * np.exp(rng.normal(size=(400, 1)) * 2)),
    "equal norms": lambda rng: (rng.normal(size=(40, 3)), (lambda m: m / np.linalg.norm(m, axis=1)[:, None])(rng.normal(size=(300, 3)))),
    "many ties": lambda rng: (rng.integers(0, 2, (30, 3)), rng.integers(0, 3, (200, 3))),
    "few positive": lambda rng: (np.abs(rng.normal(size=(20, 2))), -np.abs(rng.normal(size=(100, 2))) + (np.arange(100) % 40 == 0)[:, None] * 3),
    "fewer items than wanted": lambda rng: (rng.normal(size=(10, 2)), rng.normal(size=(3, 2))),
    "zeros": lambda rng: (np.zeros((4, 2)), rng.normal(size=(30, 2))),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("slab_bytes", [1 << 20, 3000])
def test_best_items_are_those_of_all_pairs(spark, name, slab_bytes):
    users, items = CASES[name](np.random.default_rng(len(name)))
    frame = best_items(vectors(spark, users), vectors(spark, items), 7, slab_bytes, block_items=16)
    assert found(frame) == all_pairs(users, items, 7)


def test_blocks_of_small_norm_are_skipped(spark):
    users, items = CASES["falling norms"](np.random.default_rng(1))
    counts = {}
    frame = best_items(vectors(spark, users), vectors(spark, items), 5, block_items=16, counts=counts)
    read = [row.blocks for row in frame.collect()]
    assert counts["blocks"] == 25 and len(read) == len(users)
    assert max(read) <= 25 and sum(read) < 0.5 * 25 * len(users)


def test_later_slabs_are_left_out_when_nobody_needs_them(spark):
    rng = np.random.default_rng(2)
    items = np.abs(rng.normal(size=(300, 4))) * np.where(np.arange(300) < 30, 1000, 1)[:, None]
    counts = {}
    frame = best_items(vectors(spark, np.abs(rng.normal(size=(50, 4)))), vectors(spark, items), 5, 1500, 16, counts)
    assert len(frame.collect()) == 50 and counts["rounds"] < counts["slabs"]


def test_empty_tables(spark):
    none, some = vectors(spark, np.zeros((0, 2))), vectors(spark, np.ones((3, 2)))
    assert best_items(none, some, 5).count() == 0
    assert [(r.products, r.scores) for r in best_items(some, none, 5).collect()] == [([], [])] * 3


def test_ties_on_the_last_place_go_to_smaller_ids():
    scores = np.array([[1.0, 3.0, 2.0, 2.0, 2.0, 2.0 + 1e-12]])
    assert best_of(scores, np.array([[9, 8, 7, 3, 5, 4]]), 3)[1].tolist() == [[8, 3, 4]]
