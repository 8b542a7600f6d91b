"""Secrets and personal data: the fixed rules by brute force, and what the methods add."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from shelfwise.llm import pii, queries, secrets
from shelfwise.llm.common import read  # noqa: F401

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def brute_secrets(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_personal(text):
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m[0])]


def test_secrets_of_documents(spark, base, texts):
    for row in queries.op1_secret_scan(spark, base).collect():
        expected = brute_secrets(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert set(expected) <= set(filter(None, row["spans"].split(",")))
        assert row["n_hex"] == sum(s.startswith("hex") for s in expected)


def test_random_tokens_are_found_and_names_are_not(spark):
    rng = random.Random(1)
    alphabet = secrets.ENCODINGS["base62"]
    made = ["".join(rng.choices(alphabet, k=40)) for _ in range(20)]
    plain = [f"some_module_name_v{i}/path2file{2000 + i}index" for i in range(20)]
    rows = [(i, f"🙂 see {t} here") for i, t in enumerate(made + plain)]
    found = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(bool(found[i]) for i in range(20)) >= 18
    assert not any(found[i] for i in range(20, 40))
    hit = next(found[i][0] for i in range(20) if found[i])
    assert (hit["start"], hit["end"]) == (6, 46)


def test_step_up_without_tokens():
    assert secrets.rejection_steps([], 0.01) == [secrets.MAX_STEP + 1] * len(secrets.LENGTH_CLASSES)


def test_redaction_keeps_the_rest(spark):
    text = "a token = '0123456789abcdef' b " + "f0" * 20
    out = secrets.redact(spark.createDataFrame([(1, text, 7), (2, None, 8)], "doc_id bigint, text string, start int"))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] == "a [SECRET]' b [SECRET]" and rows[1]["start"] == 7 and rows[2]["text"] is None


def test_awkward_secrets(awkward, nothing):
    assert secrets.scan_secrets(awkward).count() == awkward.count()
    assert secrets.scan_secrets(nothing).count() == 0


def test_personal_data_of_documents(spark, base, texts):
    for row in queries.op7_weak_supervision_pii(spark, base).collect():
        expected = brute_personal(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert set(expected) <= set(filter(None, row["spans"].split(",")))


def test_personal_data_in_random_strings(spark):
    rng = random.Random(2)
    parts = ["a", "b.c", "@", "@x.de", ".", "..", "-", " ", "1", "255", "256", "4111111111111111", "+49", "(", ")", "\x01", "\x02", "🙂", "%", "1.2.3.4"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(600)]
    out = pii.find_personal(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = dict(out.select("doc_id", pii.span_text(F.col("base"))).collect())
    assert {i: found[i] for i, t in rows if found[i] != ",".join(brute_personal(t))} == {}


def test_reliabilities_separate_two_classes():
    yes, no = sum(3**k for k in range(4)), 0
    posterior = pii.reliabilities({yes: 90, no: 60})
    assert posterior[yes] > 0.9 > 0.1 > posterior[no]


def test_awkward_personal(awkward, nothing):
    out = pii.find_personal(awkward)
    assert out.count() == awkward.count() and out.filter("size(spans) > 0").isEmpty()
    assert pii.find_personal(nothing).count() == 0
