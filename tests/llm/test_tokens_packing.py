"""Token counts and packing against the tokenizer library, and exact covers."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from shelfwise.llm import packing, queries, tokens
from shelfwise.llm.common import vocabulary

PARTS = [
    "a", "the", "The", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", " '", "1", "22", "é", "ß", "ẞ", "中文", "　",
    "\x1c", "\x85", "!", "...", "<|endoftext|>", "_", "-", "ing", "\r\n", "🙂", "²", "Σ", "İ", "é", "가", "ᄀ", "Ᲊ", "\0",
]


def strings(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(n)]


def test_counts_are_those_of_the_library():
    path = vocabulary("byte_bpe_50k.json")
    made = strings(4000, 1)
    library = Tokenizer.from_file(path).encode_batch(made, add_special_tokens=False)
    assert tokens.TokenCounter(path).count(made) == [len(e.ids) for e in library]


def test_scan_of_maps_equals_one_run():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, 8, (37, 8)).astype(np.uint8)
    state, scanned = 3, tokens.prefix_scan(maps)
    for one, upto in zip(maps, scanned):
        state = one[state]
        assert upto[3] == state


def test_counts_of_documents(spark, base, texts):
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for row in queries.op8_transducer_tokens(spark, base).collect():
        text = texts[row["doc_id"]]
        assert row["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert row["n_bytes"] == len(text.encode()) and row["over_limit"] == (row["n_tokens"] > 1024)


def test_awkward_counts(awkward, nothing):
    path = vocabulary("byte_bpe_50k.json")
    assert tokens.count_tokens(awkward, path).count() == awkward.count()
    assert tokens.count_tokens(nothing, path).count() == 0


def test_ids_are_those_of_the_library():
    encoder = packing.WordIds(vocabulary("word_bpe_49k.json"))
    made = strings(4000, 2)
    library = encoder.whole.encode_batch(made, add_special_tokens=False)
    assert [ids.tolist() for ids in encoder.encode(made)] == [e.ids for e in library]


def check_cover(rows, whole):
    """Pieces cover every document once, sequences have no gap and do not overflow."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for doc, ids in whole.items():
        at = 0
        for row in sorted(pieces[doc], key=lambda r: r["start"]):
            assert row["start"] == at and row["length"] > 0 and row["doc_tokens"] == len(ids)
            at += row["length"]
            part = np.array(ids[row["start"] : at], "<u4")
            assert row["ids_crc32"] == zlib.crc32(part.tobytes())
        assert at == len(ids)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


def test_packing_of_documents(spark, base, texts):
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    whole = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    sequences = check_cover(queries.op5_retrieval_packing(spark, base).collect(), whole)
    assert sequences <= -(-sum(map(len, whole.values())) // 2048) + 1


def test_neighbours_share_words():
    docs = [np.array(d, np.uint16) for d in ([5, 6, 7], [8, 9], [5, 6, 3], [2, 9])]
    scores = packing.Index(docs, 10).neighbours(0)
    assert scores.argsort()[-2:].tolist() == [2, 0] and scores[1] == 0


def test_awkward_packing(awkward, nothing):
    path = vocabulary("word_bpe_49k.json")
    rows = packing.pack(awkward.filter("doc_id <> 3"), path).collect()
    library = Tokenizer.from_file(path)
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.filter("doc_id <> 3").collect()}
    check_cover(rows, {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()})
    assert packing.pack(awkward, path).filter("doc_id is null").count() == 1
    assert packing.pack(awkward, path).filter("doc_id = 3").count() == 2
    assert packing.pack(nothing, path).count() == 0
