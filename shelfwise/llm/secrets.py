"""Secrets in texts: fixed patterns, and tokens that only randomness explains.

Tokens of a credential alphabet go through three tests of their inferred encoding:
chi-squared uniformity over the alphabet, a runs test of character classes, and the
lag-one serial correlation of symbols. Each is read twice. Against "uniformly random"
a token must not fail. Against "written by people" the three p-values are combined, and
a step-up procedure over all tokens of all documents, weighted by token length, decides
which are secrets at a stated false-discovery rate.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from statistics import NormalDist

import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import give_back, id_and_text, slices
from shelfwise.sources.tables import materialize

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_LENGTH = 16
#: An equals sign before a token parts it from a name, behind it is padding.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the narrowest alphabet to the widest; the first that holds a token is inferred.
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "hex upper": _DIGITS + "ABCDEF",
    "base32": "234567" + _UPPER,
    "base36": _DIGITS + _LOWER,
    "base36 upper": _DIGITS + _UPPER,
    "base62": _DIGITS + _LOWER + _UPPER,
    "base64": _DIGITS + _LOWER + _UPPER + "+/",
    "base64 url": _DIGITS + _LOWER + _UPPER + "-_",
}
#: Alphabets of tokens without a digit.
LETTERS = {"lower": _LOWER, "upper": _UPPER, "letters": _LOWER + _UPPER}
ENCODINGS |= LETTERS
_SETS = {name: frozenset(alphabet) for name, alphabet in ENCODINGS.items()}
_INDEX = {name: {c: i for i, c in enumerate(alphabet)} for name, alphabet in ENCODINGS.items()}

# The model of what people write (names with numbers, paths, dates): the sum of squared
# symbol frequencies, the share of positions where the character class changes, and the
# serial correlation that classes kept together give.
WRITTEN_CONCENTRATION, WRITTEN_SWITCHES, WRITTEN_CORRELATION = 0.11, 0.12, 0.55
#: The sum of squared frequencies of letters in words, whatever the language at least.
LETTER_CONCENTRATION = 0.06
#: A token that is this unlikely under uniform randomness is not random.
RANDOM_LEVEL = 1e-4
#: p-values are rounded up to a grid of so many steps a decade before they are counted.
STEPS, MAX_STEP = 4, 240
#: Lower ends of the length classes, and their weights: longer tokens are likelier secrets.
LENGTH_CLASSES = (16, 20, 24, 32, 40, 64, 128)
LENGTH_WEIGHTS = (0.25, 0.5, 1.0, 2.0, 2.0, 2.0, 1.0)

_phi = NormalDist().cdf


def encoding_of(token: str) -> str | None:
    """The narrowest encoding that holds the token. Digits alone give none: numbers are
    not credentials by themselves. Letters alone have alphabets of their own."""
    symbols = set(token.rstrip("="))
    if not any(c.isalpha() for c in symbols):
        return None
    digits = bool(symbols & set(_DIGITS))
    return next((name for name, alphabet in _SETS.items() if (name in LETTERS) != digits and symbols <= alphabet), None)


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def battery(token: str, encoding: str) -> tuple[float, float]:
    """(p-value of "random", combined p-value of "written") for one token."""
    body = token.rstrip("=")
    n, k, index = len(body), len(ENCODINGS[encoding]), _INDEX[encoding]
    codes = [index[c] for c in body]

    # Uniformity: Pearson's statistic by its exact mean and variance under either model.
    chi = sum(c * c for c in Counter(codes).values()) * k / n - n
    random_sd = math.sqrt(2 * (k - 1) * (n - 1) / n)
    p_random = [1 - _phi((chi - (k - 1)) / random_sd)]
    concentration = LETTER_CONCENTRATION if encoding in LETTERS else WRITTEN_CONCENTRATION
    extra = (n - 1) * max(k * concentration - 1, 0.15)
    p_written = [_phi((chi - (k - 1) - extra) / math.sqrt(random_sd**2 + 4 * extra))]

    # Runs of character classes, and serial correlation of neighbouring symbols. Of one class
    # there are no runs, and what neighbours share in words of one case is not known.
    share = Counter(_class(c) for c in ENCODINGS[encoding])
    expected = 1 - sum((s / k) ** 2 for s in share.values())
    if expected:
        classes = [_class(c) for c in body]
        switches = sum(a != b for a, b in zip(classes, classes[1:]))
        for p, rate, side in ((p_random, expected, -1), (p_written, WRITTEN_SWITCHES, 1)):
            z = (switches - (n - 1) * rate) / math.sqrt((n - 1) * rate * (1 - rate))
            p.append(1 - _phi(side * z))
        mean = sum(codes) / n
        spread = sum((c - mean) ** 2 for c in codes)
        r = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:])) / spread if spread else 1.0
        p_random.append(1 - _phi((r + 1 / n) * math.sqrt(n)))
        p_written.append(_phi((r - WRITTEN_CORRELATION) * math.sqrt(n)))
    else:
        p_written += [1.0, 1.0]

    # Bonferroni for the first reading; Fisher's sum, six degrees of freedom, for the second.
    half = -sum(math.log(max(p, 1e-60)) for p in p_written)
    combined = math.exp(-half) * (1 + half + half * half / 2)
    return min(1.0, 3 * min(p_random)), min(1.0, combined)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, sorted."""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, p-value step) of tokens that pass as random."""
    found = []
    for m in TOKEN.finditer(text):
        token = m.group()
        encoding = encoding_of(token)
        if encoding is None or any(s <= m.start() and m.end() <= e for s, _, e in base):
            continue
        p_random, p_written = battery(token, encoding)
        if p_random < RANDOM_LEVEL:
            p_written = 1.0
        step = min(MAX_STEP, int(-math.log10(max(p_written, 1e-300)) * STEPS))
        size = sum(len(token) >= low for low in LENGTH_CLASSES) - 1
        found.append((m.start(), m.end(), size, step))
    return found


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_CANDIDATE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("size", pa.int32()), ("step", pa.int32())])


def _examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 8 << 20):
        base, digests, tested = [], [], []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            key = ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            digests.append(hashlib.sha256(key.encode()).hexdigest())
            tested.append(
                [dict(zip(("start", "end", "size", "step"), c)) for c in candidates(text, spans)]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(digests, pa.string()),
             pa.array(tested, pa.list_(_CANDIDATE))],
            ["doc_id", "base", "base_sha256", "tested"],
        )
    give_back()


def rejection_steps(counts: list[tuple[int, int, int]], rate: float) -> list[int]:
    """The least significant step that still counts as a secret, per length class.

    ``counts`` holds (length class, step, tokens). This is the weighted step-up
    procedure: p-values are divided by the class weight, weights average one over
    all tokens, and the largest level with enough tokens below it is taken.
    """
    total = sum(n for _, _, n in counts)
    none = [MAX_STEP + 1] * len(LENGTH_CLASSES)
    if not total:
        return none
    mean = sum(LENGTH_WEIGHTS[size] * n for size, _, n in counts) / total
    level = lambda size, step: 10 ** (-step / STEPS) * mean / LENGTH_WEIGHTS[size]
    below, best = 0, 0.0
    for value, n in sorted((level(size, step), n) for size, step, n in counts):
        below += n
        if value <= rate * below / total:
            best = value
    steps = []
    for size in range(len(LENGTH_CLASSES)):
        passing = [step for step in range(MAX_STEP + 1) if level(size, step) <= best]
        steps.append(min(passing, default=MAX_STEP + 1))
    return steps


def _examined(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()
    found = id_and_text(docs, id_column, text).mapInArrow(
        _examine,
        f"doc_id {kind}, base array<struct<start:bigint,kind:int,end:bigint>>, base_sha256 string, "
        "tested array<struct<start:bigint,end:bigint,size:int,step:int>>",
    )
    return materialize(found, "secrets")


def _decided(examined: DataFrame, rate: float) -> list[int]:
    tested = examined.select(F.explode("tested").alias("t")).groupBy("t.size", "t.step").count()
    return rejection_steps([tuple(row) for row in tested.collect()], rate)


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rate: float = 0.01) -> DataFrame:
    """doc_id, base_sha256, spans (array of start, kind number, end) for every row of ``docs``.

    A null text is empty and has no span, repeated rows give repeated results, null ids
    stay null, further columns are not read. The only thing that comes to the driver is
    the count of tokens per length class and p-value step, at most 7 x 241 numbers.
    """
    examined = _examined(docs, id_column, text)
    limits = F.array(*[F.lit(step) for step in _decided(examined, rate)])
    chosen = F.transform(
        F.filter("tested", lambda t: t["step"] >= F.get(limits, t["size"])),
        lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")),
    )
    return examined.select("doc_id", "base_sha256", F.array_sort(F.concat("base", chosen)).alias("spans"))


#: What stands for a secret in a redacted text.
MARK = "[SECRET]"


def _redact_text(text: str, steps: list[int]) -> str:
    base = base_spans(text)
    spans = [(start, end) for start, _, end in base]
    spans += [(start, end) for start, end, size, step in candidates(text, base) if step >= steps[size]]
    parts, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], MARK]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rate: float = 0.01) -> DataFrame:
    """``docs`` with a mark in place of every secret, all other columns as they are; overlapping
    spans give one mark. Texts are examined again here, by the levels that all of them decide,
    so that no table has to be joined back. A null text stays null."""
    steps = _decided(_examined(docs, id_column, text), rate)

    def run(texts: pd.Series) -> pd.Series:
        redacted = pd.Series([None if t is None else _redact_text(t, steps) for t in texts], dtype=object)
        give_back()
        return redacted

    return docs.withColumn(text, F.pandas_udf(run, "string")(F.col(text)))


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
