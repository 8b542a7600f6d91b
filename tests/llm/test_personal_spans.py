"""Spans that the fixed rules do not cover, and texts of very many candidates."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from shelfwise.llm import pii

SCHEMA = "doc_id bigint, text string"


def spans(out):
    return {row.doc_id: [(pii.KINDS[s.kind], s.start, s.end) for s in row.spans] for row in out.collect()}


def planted(rng):
    """(text, number) with a number written as inside a country, behind an announcing word."""
    word = rng.choice(["Tel.", "tel:", "Phone:", "call", "Telefon", "mobile", "Fax:", "Teléfono:"])
    digits = "".join(rng.choices("123456789", k=9))
    number = rng.choice([f"0{digits[:2]} {digits[2:5]} {digits[5:]}", f"(0{digits[:3]}) {digits[3:]}", f"0{digits[:3]}/{digits[3:]}", f"{rng.choice('23456789')}{digits[:2]}-{digits[2:5]}-{digits[5:]}{digits[0]}"])
    return f"Ask for ü {word} {number} today", number


def test_planted_national_numbers_are_added(spark):
    rng = random.Random(4)
    made = [planted(rng) for _ in range(200)]
    others = [f"+49 30 {rng.randrange(10**7, 10**8)} is the number" for _ in range(100)]
    plain = ["Call 911 now, room 12 of 30", "chapter 0302 1234567 of volume 3", "hotel 030 1234567 rooms", "ip 300.1.2.3 and card 4111 1111 1111 1112", "call 5"]
    rows = [(i, t) for i, t in enumerate([t for t, _ in made] + others + plain)]
    found = spans(pii.find_personal(spark.createDataFrame(rows, SCHEMA)))
    hits = sum(found[i] == [("phone", t.index(number), t.index(number) + len(number))] for i, (t, number) in enumerate(made))
    assert hits >= 190
    assert all(len(found[i]) == 1 for i in range(200, 300))
    assert not any(found[i] for i in range(300, 305))


def test_nothing_is_added_to_what_cannot_be(spark):
    rows = [(i, f"login from host 10.0.0.{i}") for i in range(200)] + [(1000, "login from host 300.1.2.3"), (1001, "visa card 4111111111111112")]
    rows += [(2000 + i, "visa card 4111111111111111") for i in range(200)]
    found = spans(pii.find_personal(spark.createDataFrame(rows, SCHEMA)))
    assert found[1000] == found[1001] == [] and len(found[5]) == len(found[2005]) == 1


def test_a_text_of_very_many_candidates(spark):
    rng = random.Random(1)
    numbers = [f"+49 30 {rng.randrange(10**7, 10**8)}" for _ in range(60_000)]
    text = "🙂; ".join(numbers)
    start = time.perf_counter()
    out = pii.find_personal(spark.createDataFrame([(1, text), (2, None)], SCHEMA)).select("doc_id", F.size("base").alias("n"), F.get("base", F.lit(59_999)).alias("last"))
    rows = {row.doc_id: row for row in out.collect()}
    assert time.perf_counter() - start < 90
    assert rows[1].n == 60_000 and (rows[1].last.start, rows[1].last.end) == (len(text) - len(numbers[-1]), len(text)) and rows[2].n == 0
