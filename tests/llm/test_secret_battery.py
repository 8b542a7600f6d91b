"""The randomness battery and the step-up over all tokens, against their definitions and planted secrets."""

from __future__ import annotations

import random

import pytest

from shelfwise.llm import secrets

SHAPES = ("MY_KEY={}", "export AUTH={}", "https://x.org/a?sig={}&v=1", "auth: {},", "see {}.", '"{}"')


def test_step_up_by_its_definition():
    rng = random.Random(3)
    for _ in range(60):
        counts = [(rng.randrange(7), rng.randrange(60), rng.randint(1, 30)) for _ in range(rng.randint(1, 40))]
        counts = list({(a, b): (a, b, n) for a, b, n in counts}.values())
        tokens = [(size, step) for size, step, n in counts for _ in range(n)]
        mean = sum(secrets.LENGTH_WEIGHTS[size] for size, _ in tokens) / len(tokens)
        levels = [10 ** (-step / secrets.STEPS) * mean / secrets.LENGTH_WEIGHTS[size] for size, step in tokens]
        order = sorted(levels)
        best = max((p for k, p in enumerate(order, 1) if p <= 0.05 * k / len(order)), default=0.0)
        steps = secrets.rejection_steps(counts, 0.05)
        for (size, step), level in zip(tokens, levels):
            assert (step >= steps[size]) == (level <= best)


@pytest.mark.parametrize("alphabet, least", [("hex", 0.9), ("base32", 0.85), ("base36", 0.9), ("base62", 0.97), ("base64", 0.97), ("letters", 0.95)])
def test_planted_secrets_of_24_characters_are_found(spark, alphabet, least):
    rng = random.Random(alphabet)
    symbols = secrets.ENCODINGS[alphabet]
    planted = ["".join(rng.choices(symbols, k=24)) for _ in range(300)]
    words = ["internationalization", "some_module_name_v2/path2file2024index", "Donaudampfschifffahrt", "THEREISNOPLACELIKEHOME", "getElementByIdentifier"]
    rows = [(i, f"🙂 {SHAPES[i % len(SHAPES)].format(token)} end") for i, token in enumerate(planted)]
    rows += [(1000 + i, f"a {words[i % 5]} = {words[(i + 1) % 5]} b") for i in range(500)]
    found = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    hits = sum(any(text[s["start"] : s["end"]] == token for s in found[i]) for (i, text), token in zip(rows, planted))
    assert hits >= least * len(planted)
    assert not any(found[1000 + i] for i in range(500))


def test_encodings():
    assert secrets.encoding_of("1234567890123456") is None and secrets.encoding_of("snake_case_words") is None
    assert secrets.encoding_of("abcdefabcdefabcdef") == "lower" and secrets.encoding_of("ABCDEFABCDEFABCDEF") == "upper"
    assert secrets.encoding_of("abcdefABCDEFabcdef") == "letters" and secrets.encoding_of("abcdef0123456789") == "hex"
    assert secrets.encoding_of("Ab0=") == "base62" and secrets.encoding_of("Ab0+/") == "base64"


def test_an_equals_sign_parts_a_token_from_its_name():
    token = "9fK3jd82HdkLq0ZpVx7T1a"
    for text in (f"MY_KEY={token}", f"auth={token}", f"?sig={token}", f"KEY=={token}=="):
        (start, end, *_), = secrets.candidates(text, [])
        assert text[start:end].rstrip("=") == token


@pytest.mark.parametrize("encoding", list(secrets.ENCODINGS))
def test_battery_of_odd_tokens(encoding):
    symbols = secrets.ENCODINGS[encoding]
    for token in (symbols[0] * 16, symbols[:16], symbols * 20, (symbols[0] + symbols[-1]) * 500):
        for p in secrets.battery(token, encoding):
            assert 0 <= p <= 1
