"""Byte-pair encoding by distinct words, source divergences, spelling variants."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from shelfwise.llm import byte_pairs, divergence, queries, spelling
from shelfwise.llm.common import vocabulary

RANKS = vocabulary("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_pairs.ranks(RANKS), special_tokens={})


# Byte-level BPE


@pytest.mark.parametrize("longest", [0, 64])
def test_merges_are_the_librarys(library, monkeypatch, longest):
    monkeypatch.setattr(byte_pairs, "LONG_WORD", longest)
    rng = random.Random(7)
    for _ in range(600):
        word = bytes(rng.choice(b"aabcdeinst \xc3\xa9\xff") for _ in range(rng.randint(1, 90)))
        assert byte_pairs.merge(word, byte_pairs.ranks(RANKS)) == library._encode_single_piece(word)


def test_long_runs_merge_fast(library):
    for word in (b"a" * 50_000, b" " * 50_000, bytes(random.Random(1).choices(b"enrstai", k=50_000))):
        assert byte_pairs.merge(word, byte_pairs.ranks(RANKS)) == library._encode_single_piece(word)


def test_every_character_is_split_as_in_the_library(library):
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    _, exact, odd = byte_pairs.splitters(PATTERN)
    text = "a" + "a 7".join(c + "9" + c for c in characters)
    ids = [i for word in exact(text) for i in byte_pairs.merge(word.encode(), byte_pairs.ranks(RANKS))]
    assert ids == library.encode_ordinary(text)
    assert min(ord(c) for c in characters if len(byte_pairs.splitters(PATTERN)[0]("a" + c)) != len(exact("a" + c))) >= odd


def expected(library, text):
    text = text or ""
    ids = library.encode_ordinary(text)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_documents_as_the_library_encodes_them(spark, base, texts, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(byte_pairs, "SHARD_WORDS", 3_000)
    found = queries.op11_distinct_word_bpe(spark, base).collect()
    assert {row.doc_id: tuple(row)[1:] for row in found} == {i: expected(library, text) for i, text in texts.items()}


def test_awkward_rows_encode_row_by_row(spark, awkward, nothing, library):
    many = " ".join(f"w{i}é <|endoftext|> \u0558" for i in range(30_000))
    rows = awkward.unionByName(spark.createDataFrame([(77, many)], "doc_id bigint, text string"), allowMissingColumns=True)
    clashing = rows.withColumn("ids", F.lit("x")).withColumn("block", F.lit("x"))
    found = Counter(tuple(row) for row in byte_pairs.round_trip(clashing, RANKS, PATTERN).collect())
    assert found == Counter((row.doc_id, *expected(library, row.text)) for row in rows.collect())
    assert byte_pairs.round_trip(nothing, RANKS, PATTERN).count() == 0
    encoded = byte_pairs.encode(rows, RANKS, PATTERN).collect()
    assert Counter((row.doc_id, tuple(row.ids)) for row in encoded) == Counter((row.doc_id, tuple(library.encode_ordinary(row.text or ""))) for row in rows.collect())


def test_text_ids_and_plain_decoding(spark):
    docs = spark.createDataFrame([("a", "Grüße, 你好!"), (None, "x")], "doc_id string, text string")
    decoded = byte_pairs.decode(byte_pairs.encode(docs, RANKS, PATTERN), RANKS).collect()
    assert {(row.doc_id, bytes(row.decoded).decode()) for row in decoded} == {("a", "Grüße, 你好!"), (None, "x")}
    unknown = spark.createDataFrame([(1, [50256 + 7])], "doc_id int, ids array<int>")
    with pytest.raises(Exception):
        byte_pairs.decode(unknown, RANKS).collect()


# Divergences


def audit_by_hand(rows, least, top):
    """(lang, source, part, item, value, rank) from (lang, source, text) rows, straight from the definition."""
    counts, holds, groups = Counter(), Counter(), set()
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups.add((lang, source))
        counts.update((lang, source, t) for t in terms)
        holds.update((lang, t) for t in set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for (l, t), n in holds.items() if l == lang and n >= least]
        own = sorted(s for l, s in groups if l == lang)
        def shares(count):
            total = sum(map(count, kept))
            return {t: 1 + 1_000_000_000 * (count(t) + 5) // (total + 5 * len(kept)) for t in kept}
        p = {s: shares(lambda t, s=s: counts[lang, s, t]) for s in own}
        q = shares(lambda t: sum(counts[lang, s, t] for s in own))
        pairs = [(sum(abs(p[source][t] - p[s][t]) for t in kept), s) for s in own if s != source]
        terms = [(p[source][t] - q[t], t) for t in kept if counts[lang, source, t] and p[source][t] > q[t]]
        for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
            best = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
            out |= {(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(best)}
    return out


AUDIT_ROWS = [
    *((lang, f"s{i % 5}", " ".join(random.Random(i).choices(["The", "the", "café", "x\x00y", "z", "ÉTÉ", "été", "a1b", "日本"], k=30))) for i in range(60) for lang in ("en", "fr")),
    (None, None, None), ("en", None, ""), ("en", "empty", None), ("de", "alone", "word word"), ("fr", "s0", "the " * 20_000), ("fr", "s0", "the " * 20_000),
]


@pytest.mark.parametrize("cells, sources, held", [(1 << 21, 1024, 1 << 20), (12, 2, 3)])
def test_audit_against_the_definition(spark, monkeypatch, cells, sources, held):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "SOURCES", sources)
    monkeypatch.setattr(divergence, "HELD_ROWS", held)
    docs = spark.createDataFrame([(None, *row, "x", "x", 1) for row in AUDIT_ROWS], "doc_id int, lang string, source string, text string, term string, shard string, n int")
    found = divergence.audit(docs, least_documents=3, top_terms=4)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(row) for row in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == audit_by_hand(AUDIT_ROWS, 3, 4)


def test_audit_of_awkward_and_empty_tables(spark, awkward, nothing):
    rows = [(row.lang, row.source, row.text) for row in awkward.collect()]
    found = divergence.audit(awkward, least_documents=1)
    assert {tuple(row) for row in found.collect()} == audit_by_hand(rows, 1, 50)
    assert divergence.audit(nothing).count() == 0


def test_shares_of_huge_counts_are_exact(spark):
    count, total, terms = 9 * 10**14, 10**15 + 7, 10**6 + 1
    frame = spark.createDataFrame([(count, total, terms)], "n bigint, total bigint, v bigint")
    found = frame.select(divergence.share("n", "total", "v")).first()[0]
    assert found == 1 + 10**9 * (count + 5) // (total + 5 * terms)


# Spelling variants


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None
    out = set()
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        out.add((word, form[word], root, counts[word], len(near[word]), counts[form[word]] if form[word] else None))
    return out


def made_words():
    rng = random.Random(3)
    made = set()
    for stem in ("aaaaaaaa", "aaaaaaa", "abababab", "straße-n".replace("-", ""), "éàüöñçß", "m" * 300):
        for _ in range(60):
            word = list(stem)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(word))
                word[at : at + rng.randint(0, 1)] = [rng.choice("abéz")] * rng.randint(0, 2)
            made.add("".join(word))
    made |= {f"prefixes{a}{b}" for a in "abcdefgh" for b in "abcdefgh"} | {f"{a}{b}suffixes" for a in "abcdefgh" for b in "abcdefgh"}
    return {word: rng.choice([2, 3, 25, 400, 5000]) for word in made if len(word) >= 7}


@pytest.mark.parametrize("group_words, tile_rows", [(2048, 96), (3, 4)])
def test_near_words_against_all_pairs(spark, monkeypatch, group_words, tile_rows):
    counts = made_words()
    monkeypatch.setattr(spelling, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(spelling, "SHARD_ROWS", 500)
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = Counter(tuple(row) for row in spelling.near_words(frame, group_words).collect())
    assert found == Counter((a, b, counts[b]) for a, b in itertools.permutations(counts, 2) if one_edit(a, b))


def test_groups_stay_small(spark):
    frame = spark.createDataFrame([(f"prefix{i:05d}", 2) for i in range(5000)], "word string, n bigint")
    sizes = spelling.meeting_groups(frame, 50).groupBy(*spelling.WINDOW).count()
    assert sizes.agg(F.max("count")).first()[0] <= 50


def words_by_hand(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {word: n for word, n in found.items() if n >= 2}


def test_variants_of_texts(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 20)
    rng = random.Random(5)
    stems = ["Straßenbahn", "fenêtres", "ÀÉÎÕÜ÷×ÿ", "management", "manage", "bookkeeper", "abcdefg"]
    rows = [(i if i % 9 else None, " ".join(rng.choices(stems, weights=[9, 5, 3, 9, 9, 1, 4], k=60)) + "1managements" * (i % 3)) for i in range(150)]
    rows += [(0, "x" * 70_000), (0, "x" * 70_000), (4, None), (5, "")]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id bigint, text string, word string, n int")
    for frame in (docs, awkward):
        given = [(row.doc_id, row.text) for row in frame.collect()]
        found = spelling.variants(frame)
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert Counter(tuple(row) for row in found.collect()) == Counter(variants_by_hand(words_by_hand(given)))
    assert spelling.variants(nothing).count() == 0


def test_chains_of_forms_reach_their_end(spark):
    forms = spark.createDataFrame([(f"w{i:02d}", f"w{i + 1:02d}") for i in range(18)], "word string, form string")
    assert {row.root for row in spelling._rooted(forms, 10).collect()} == {"w18"}
    with pytest.raises(ValueError):
        spelling.variants(forms.selectExpr("1 doc_id", "word text"), ratio=1)


def test_tiles_of_a_made_shard():
    table = pa.table({"size": [8] * 3, "lo": [0] * 3, "hi": [4] * 3, "head": [""] * 3, "tail": ["efgh"] * 3,
                      "word": ["abcdefgh", "abcefgh", "xbcdefgh"], "n": [5, 6, 7]})
    pairs = {tuple(row.values()) for row in spelling._near_words(table).to_pylist()}
    assert pairs == {("abcdefgh", "abcefgh", 6), ("abcefgh", "abcdefgh", 5), ("abcdefgh", "xbcdefgh", 7), ("xbcdefgh", "abcdefgh", 5)}
