"""Personal data in texts, by weak supervision.

Patterns find candidate spans, and the context labeler proposes further ones: phone numbers as they are
written inside a country, behind a word that announces one. Labelers vote on each: the pattern's own checks, gazetteers of
prefixes and domains, context words before it, and its shape. Expectation-maximisation over the
counts of vote combinations estimates how reliable each labeler is, and its posteriors are
the soft labels of a span classifier over discrete features. What the fixed rules find stays;
the classifier adds phone numbers that they do not cover. Addresses with a part over 255 and cards with a
wrong check digit are none, whatever stands around them. Functions of Spark SQL only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.tables import materialize

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the rules, equal to them and free of backtracking: a match can only begin
# where a run of its characters begins, or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": f"(?:\\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?+[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: Words that announce a phone number (fixed values), and numbers behind one without a country code.
ANNOUNCING = "phone|telephone|tel|mobile|cell|call|fax|telefon|handy|mobil|móvil|teléfono|llamar|portable|téléphone|appeler"
NATIONAL = (
    f"(?<=(?<![\\p{{L}}])(?i:{ANNOUNCING})(?:\\.:?|:)?\\x20{{1,2}})"
    "\\(?[0-9][0-9()]*+(?:[\\x20./-]{1,2}[0-9()]*[0-9][0-9()]*+)*+(?<=[0-9])"
)
#: What proposes candidates: the pattern of each kind, and the context of national numbers.
SOURCES = [*((kind, PATTERNS[kind]) for kind in KINDS), ("phone", NATIONAL)]
#: Words before a span that speak for its kind (fixed values).
CONTEXT = {
    "email": "mail|e-mail|contact|write|address|kontakt|correo|courriel",
    "ip": "ip|host|server|address|login|from|client",
    "card": "card|visa|credit|debit|payment|account|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|contact|telefon|llamar|appel",
}
#: Beginnings or ends that are in use: mail domains, card issuers, country codes (fixed values).
GAZETTEER = {
    "email": "\\.(com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$",
    "ip": "^(?!0|10\\.|127\\.|169\\.254\\.|192\\.168\\.|22[4-9]\\.|2[3-9][0-9]\\.)",
    "card": "^(4|5[1-5]|2[2-7]|3[4-7]|6[025])",
    "phone": "^\\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
}
#: Beginnings of numbers without a country code: a trunk prefix, or an area code of three digits.
TRUNK = "^(0[1-9]|[2-9][0-9]{9}$)"
ABSTAIN = 2
MARK, END, OTHER = "\x01", "\x02", "\x03"
LABELERS = 4
ROUNDS = 30
#: Posterior above which a candidate that fails the fixed rules is added.
ADD_ABOVE = 0.9


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    doubled = F.transform(
        values,
        lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """The fixed rule's check of a match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(f"^{part}(?:\\.{part}){{3}}$")
    count = F.length(_digits(match))
    if kind == "phone":
        return count.between(8, 15)
    return count.between(16, 19) & luhn(_digits(match))


def possible(kind: str, match: Column) -> Column:
    """Whether a match that the fixed rules leave out can be of the kind at all."""
    if kind != "phone":
        return F.lit(False)
    return F.length(_digits(match)).between(7, 15)


def _guarded(number: int) -> Column:
    """A cheap sign without which a source has no match."""
    text = F.col("text")
    signs = [
        text.contains("@"), text.rlike("[0-9]\\.[0-9]"), text.rlike("[0-9][\\x20-]?[0-9]"), text.contains("+"),
        text.rlike(f"(?i:{ANNOUNCING})(?:\\.:?|:)?\\x20{{1,2}}[(0-9]"),
    ]
    return signs[number]


def _votes(kind: str, match: Column, before: Column, after: Column, proposed: bool) -> list[Column]:
    """0, 1 or abstention of each labeler. The fixed rules say nothing on what the context has ``proposed``."""
    digits = F.length(_digits(match))
    yes, no = F.lit(1), F.lit(0)
    abstain = F.lit(ABSTAIN)
    shape = {
        "email": F.when(F.length(match) > 100, no).otherwise(F.when(match.rlike("@[^@]*[A-Za-z]{2,}$"), yes).otherwise(no)),
        "ip": F.when(before.rlike("[.0-9]$|v(er)?(sion)? ?$") | after.rlike("^\\.[0-9]"), no).otherwise(abstain),
        "card": F.when(digits == 16, yes).when(digits.between(13, 19), abstain).otherwise(no),
        "phone": F.when(digits.between(10, 13), yes).when(digits.between(8, 15), abstain).otherwise(no),
    }[kind]
    known = F.regexp_replace(match, "[\\x20().-]", "") if kind in ("card", "phone") else F.lower(match)
    return [
        abstain if proposed else F.when(valid(kind, match), yes).otherwise(no),
        F.when(known.rlike(TRUNK if proposed else GAZETTEER[kind]), yes).otherwise(no),
        F.when(before.rlike(f"(?:{CONTEXT[kind]})[^\\n]*$"), yes).otherwise(abstain),
        shape,
    ]


def _features(kind: str, match: Column, before: Column, after: Column, proposed: bool) -> list[Column]:
    """Discrete features of the span classifier, each below 32. The fixed rules are not among them."""
    return [
        F.least(F.length(_digits(match)), F.lit(31)),
        F.least(F.length(F.regexp_replace(match, "[A-Za-z0-9]", "")), F.lit(31)),
        F.when(match.rlike(GAZETTEER[kind] if kind in ("email", "ip") else "^\\+?[1-9]"), 1).otherwise(0),
        F.when(before.rlike(f"(?:{CONTEXT[kind]})[^\\n]*$"), 1).otherwise(0),
        F.when(before.rlike("[\\p{L}\\p{N}]$"), 2).when(before.rlike("[\\s:\"'(=]$"), 1).otherwise(0)
        * F.lit(4) + F.when(after.rlike("^[\\p{L}\\p{N}]"), 2).when(after.rlike("^[\\s.,;)\"']"), 1).otherwise(0),
        F.lit(int(proposed)),
    ]


FEATURES = 6
#: Parts whose lengths are summed up together, for places in linear time.
BLOCK = 256


def _parts(number: int) -> Column:
    """``text`` with the matches of a source marked, cut at the marks; null where it has none."""
    marked = F.regexp_replace("text", f"({SOURCES[number][1]})", f"{MARK}$1{END}")
    return F.when(_guarded(number), F.split(marked, MARK)).alias(f"parts{number}")


def _block_starts(lengths: Column) -> Column:
    """The sum of all lengths before each block of ``BLOCK`` ones."""
    blocks = F.sequence(F.lit(0), F.floor(F.size(lengths) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: _sum(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    # Few enough to be summed from the start each time: one per 256 parts.
    return F.transform(blocks, lambda b: _sum(F.slice(sums, F.lit(1), b)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, n: total + n)


def _spans(number: int) -> Column:
    """Candidates of a source; their places are sums of lengths of the parts before them."""
    kind, proposed = SOURCES[number][0], number >= len(KINDS)
    parts, lengths, starts = (F.col(f"{name}{number}") for name in ("parts", "lengths", "starts"))

    def span(i: Column) -> Column:
        part = F.get(parts, i)
        match = F.substring_index(part, END, 1)
        block = F.floor(i / BLOCK).cast("int")
        start = F.get(starts, block) + _sum(F.slice(lengths, block * BLOCK + 1, i - block * BLOCK))
        last = F.get(parts, i - 1)
        before = F.lower(F.translate(F.right(last, F.lit(40)), END, " "))
        after = F.substring(F.substring_index(part, END, -1), 1, 2)
        votes = _votes(kind, match, before, after, proposed)
        pattern = sum((v * 3**k for k, v in enumerate(votes[1:], 1)), votes[0])
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + F.length(match)).alias("end"),
            (F.lit(False) if proposed else valid(kind, match)).alias("valid"), possible(kind, match).alias("possible"), pattern.cast("int").alias("votes"),
            F.array(*[f.cast("int") for f in _features(kind, match, before, after, proposed)]).alias("features"),
        )

    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), span))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``, an array of all candidates, or null; ``docs`` has doc_id and text."""
    clean = docs.select("doc_id", F.translate("text", MARK + END, OTHER * 2).alias("text"))
    numbers = range(len(SOURCES))
    cut = clean.select("doc_id", *[_parts(n) for n in numbers])
    lengths = [
        F.transform(f"parts{n}", lambda part, i: F.length(part).cast("bigint") - F.when(i > 0, 1).otherwise(0)).alias(f"lengths{n}")
        for n in numbers
    ]
    measured = cut.select("*", *lengths).select("*", *[_block_starts(F.col(f"lengths{n}")).alias(f"starts{n}") for n in numbers])
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,valid:boolean,possible:boolean,votes:int,features:array<int>>>")
    return measured.select("doc_id", F.concat(*[F.coalesce(_spans(n), empty) for n in numbers]).alias("found"))


def reliabilities(counts: dict[int, int]) -> dict[int, float]:
    """The posterior of "personal" for each combination of votes of one kind.

    Expectation-maximisation of the one-coin-per-class model: each labeler has a chance of
    voting yes on personal spans and another on others; abstentions say nothing. A weak prior keeps
    labelers better than chance, which fixes which class is which.
    """
    votes = {p: [(p // 3**k) % 3 for k in range(LABELERS)] for p in counts}
    share, yes = 0.7, [[0.2, 0.8] for _ in range(LABELERS)]
    posterior: dict[int, float] = {}
    for _ in range(ROUNDS):
        for p, vote in votes.items():
            odds = math.log(share / (1 - share))
            for k, v in enumerate(vote):
                if v != ABSTAIN:
                    a, b = yes[k][1], yes[k][0]
                    odds += math.log(a / b) if v else math.log((1 - a) / (1 - b))
            posterior[p] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
        total = sum(counts.values())
        share = (sum(posterior[p] * n for p, n in counts.items()) + 7) / (total + 10)
        for k in range(LABELERS):
            for side in (0, 1):
                mass = {p: (posterior[p] if side else 1 - posterior[p]) * n for p, n in counts.items() if votes[p][k] != ABSTAIN}
                agreed = sum(m for p, m in mass.items() if votes[p][k] == 1)
                yes[k][side] = (agreed + (8 if side else 2)) / (sum(mass.values()) + 10)
    return posterior


def classifier(sums: dict[tuple[int, int, int], tuple[float, float]], totals: dict[int, tuple[float, float]]) -> dict[int, float]:
    """Log-odds by kind, feature and value, keyed as one number, of a naive Bayes model on soft labels."""
    odds = {}
    for (kind, feature, value), (good, bad) in sums.items():
        all_good, all_bad = totals[kind]
        odds[(kind * FEATURES + feature) * 32 + value] = math.log((good + 0.5) / (all_good + 1)) - math.log((bad + 0.5) / (all_bad + 1))
    return odds


def _literal(values: dict[int, float], size: int, default: float) -> Column:
    return F.array(*[F.lit(float(values.get(i, default))) for i in range(size)])


def find_personal(docs: DataFrame, id_column: str = "doc_id", text: str = "text", add_above: float = ADD_ABOVE) -> DataFrame:
    """doc_id, base and spans (arrays of kind number, start, end, sorted) for every row of ``docs``.

    ``base`` holds what the fixed rules find, ``spans`` that and what the classifier adds. A null
    text is empty and has no span, repeated rows give repeated results, null ids stay null,
    further columns are not read. To the driver come counts per kind and vote
    combination (at most 4 x 81) and per kind, feature and value (at most 4 x 6 x 32).
    """
    plain = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = materialize(candidates(plain), "personal")
    each = found.select(F.explode("found").alias("c")).select("c.*")
    counted = each.groupBy("kind", "votes").count().collect()
    posterior = {}
    for kind in range(len(KINDS)):
        own = {row["votes"]: row["count"] for row in counted if row["kind"] == kind}
        posterior |= {kind * 3**LABELERS + votes: p for votes, p in reliabilities(own).items()}
    label = F.get(_literal(posterior, len(KINDS) * 3**LABELERS, 0.5), F.col("kind") * 3**LABELERS + F.col("votes"))
    soft = each.withColumn("label", label)
    valued = soft.select("kind", "label", F.posexplode("features").alias("feature", "value"))
    sums = valued.groupBy("kind", "feature", "value").agg(F.sum("label"), F.sum(1 - F.col("label"))).collect()
    totals: dict[int, tuple[float, float]] = {}
    for kind, feature, _, good, bad in sums:
        if feature == 0:
            before = totals.get(kind, (0.0, 0.0))
            totals[kind] = (before[0] + good, before[1] + bad)
    odds = _literal(classifier({(k, f, v): (g, b) for k, f, v, g, b in sums}, totals), len(KINDS) * FEATURES * 32, 0.0)
    prior = _literal({k: math.log((g + 0.5) / (b + 0.5)) for k, (g, b) in totals.items()}, len(KINDS), 0.0)

    def accepted(c: Column) -> Column:
        score = F.aggregate(
            F.transform(c["features"], lambda v, i: F.get(odds, (c["kind"] * FEATURES + i) * 32 + v)),
            F.get(prior, c["kind"]), lambda total, x: total + x,
        )
        return c["valid"] | (c["possible"] & (score > math.log(add_above / (1 - add_above))))

    bare = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    some = F.size("found") > 0
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return found.select(
        "doc_id",
        F.when(some, F.array_sort(F.transform(F.filter("found", lambda c: c["valid"]), bare))).otherwise(empty).alias("base"),
        F.when(some, F.array_sort(F.transform(F.filter("found", accepted), bare))).otherwise(empty).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
