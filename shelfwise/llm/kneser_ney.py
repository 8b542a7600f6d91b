"""Perplexity by an interpolated modified Kneser-Ney bigram model.

Counts are gathered in Spark: tasks combine what they read, shuffles bring equal keys together,
and every shard is written as sorted arrays to the shared folder. Workers map the arrays into
memory and look up a batch's keys in sorted order. No worker holds the model, and a shard's
size does not grow with the corpus, as the number of shards follows the volume of text.

The shared folder must be a path that workers can open, such as a mounted file system.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import id_and_text, slices
from shelfwise.session import fresh_path
from shelfwise.sources.tables import materialize

WORD_SHARD_BYTES, PAIR_SHARD_BYTES = 32 << 20, 8 << 20
BATCH_BYTES = 3 << 20
#: The end of a text, as a word that no text can hold.
END = b"\n"


class _Hashes(dict):
    MAX = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.MAX:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, first token of each text). Words are lower-cased and cut as
    bytes, which touches ASCII letters and white space only."""
    tokens: list[bytes] = []
    first = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        first[i] = len(tokens)
        tokens += text.encode("utf-8", "surrogatepass").lower().split()
        tokens.append(END)
    return np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens)), first


def _spread(keys: np.ndarray) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (_spread(keys) % np.uint64(shards)).astype(np.int64)


def _blobs(keys: np.ndarray, values: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """One row (shard, blob) per shard: its keys, then each array of values."""
    shard = _shard(keys, shards)
    order = np.argsort(shard, kind="stable")
    present, first = np.unique(shard[order], return_index=True)
    blobs = []
    for a, b in zip(first, [*first[1:], len(order)]):
        rows = order[a:b]
        blobs.append(b"".join([keys[rows].astype("<u8").tobytes(), *(v[rows].astype("<u4").tobytes() for v in values)]))
    return pa.RecordBatch.from_arrays([pa.array(present, pa.int64()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def _merged(blobs: pd.Series, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their values."""
    keys, values = [], []
    for blob in blobs:
        n = len(blob) // (8 + 4 * columns)
        keys.append(np.frombuffer(blob, "<u8", n))
        values.append(np.frombuffer(blob, "<u4", n * columns, 8 * n).reshape(columns, n))
    key, value = np.concatenate(keys), np.concatenate(values, axis=1)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(value[:, order].astype(np.int64), first, axis=1)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Written aside and renamed, so that a task that runs twice does no harm."""
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    array.tofile(aside)
    os.replace(aside, f"{folder}/{name}")


class Shards:
    """Arrays of the shards of one kind, mapped into memory on first use."""

    def __init__(self, folder: str, kind: str, sizes: list[int]):
        self.folder, self.kind, self.sizes = folder, kind, sizes
        #: Whether one more shard of a single place lies behind the others: the start of a text.
        self.beyond = False
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.open: dict[str, np.ndarray] = {}

    def array(self, name: str, shard: int, dtype: str) -> np.ndarray:
        path = f"{self.folder}/{self.kind}-{name}-{shard}"
        if path not in self.open:
            self.open[path] = np.memmap(path, dtype, "r") if shard == len(self.sizes) or self.sizes[shard] else np.zeros(0, dtype)
        return self.open[path]

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among all shards' arrays, or -1. Keys should be in order."""
        out = np.full(len(keys), -1, np.int64)
        shard = _shard(keys, len(self.sizes))
        for s in np.unique(shard).tolist():
            if not self.sizes[s]:
                continue
            rows = np.flatnonzero(shard == s)
            known, wanted = self.array("keys", s, "<u8"), keys[rows]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            out[rows] = np.where(known[at] == wanted, at + self.offsets[s], -1)
        return out

    def values(self, name: str, places: np.ndarray, dtype: str = "<u4") -> np.ndarray:
        """Values at places; those at -1 are zero."""
        out = np.zeros(len(places), np.int64)
        shard = np.searchsorted(self.offsets, places, side="right") - 1
        for s in np.unique(shard[places >= 0]).tolist():
            if s == len(self.sizes) and not self.beyond:
                continue
            rows = np.flatnonzero(shard == s)
            out[rows] = self.array(name, s, dtype)[places[rows] - self.offsets[s]]
        return out


def discounts(of_counts: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more from the numbers of keys with counts 1 to 4."""
    n1, n2, n3, n4 = (float(n) for n in of_counts)
    if not (n1 and n2):
        return np.array([0, 0.5, 0.75, 0.75])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.array([0, *(float(np.clip(x, 0.01, k + 0.9)) for k, x in enumerate(d))])


class Model:
    """What a worker needs: where the arrays are, and a few totals."""

    def __init__(self, words: Shards, pairs: Shards, tokens: int, pair_of: list[int], follow_of: list[int]):
        self.words, self.pairs, self.tokens = words, pairs, tokens
        self.vocabulary = int(words.offsets[-1])
        self.discount, self.follow_discount = discounts(pair_of), discounts(follow_of[:4])
        self.kinds = int(pairs.offsets[-1])
        classes = np.array([0, follow_of[0], follow_of[1], follow_of[4]])
        self.follow_rest = float(classes @ self.follow_discount) / max(self.kinds, 1)

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of words; those that training never saw share the id after the last."""
        unique, back = np.unique(hashes, return_inverse=True)
        found = self.words.places(unique)
        return np.where(found < 0, self.vocabulary, found)[back]

    def score(self, texts: list[str]) -> dict[str, np.ndarray]:
        hashes, first = token_hashes(texts)
        sizes = np.diff(np.append(first, len(hashes)))
        word = self.word_ids(hashes)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[first] = self.vocabulary + 1

        unique, back = np.unique(word, return_inverse=True)
        place = np.where(unique < self.vocabulary, unique, -1)
        count = self.words.values("counts", place)
        base = np.log10((count + 1) / (self.tokens + self.vocabulary + 1))
        kinds = self.words.values("before", place)
        lower = np.maximum(kinds - self.follow_discount[np.minimum(kinds, 3)], 0) / max(self.kinds, 1)
        lower = lower + (self.follow_rest if self.kinds else 1.0) / (self.vocabulary + 1)

        context, context_back = np.unique(before, return_inverse=True)
        at = np.where(context < self.vocabulary, context, np.where(context == self.vocabulary, -1, self.vocabulary))
        total, *classes = (self.words.values(name, at) for name in CONTEXT)
        rest = sum(d * n for d, n in zip(self.discount[1:], classes))
        key, key_back = np.unique(pair_keys(before, word), return_inverse=True)
        seen = self.pairs.values("counts", self.pairs.places(key))
        kept = np.maximum(seen - self.discount[np.minimum(seen, 3)], 0)
        known = total > 0
        scale = np.where(known, 1 / np.maximum(total, 1), 0)
        weight = np.where(known, rest / np.maximum(total, 1), 1.0)
        chance = kept[key_back] * scale[context_back] + weight[context_back] * lower[back]
        add = lambda values: np.add.reduceat(values, first)
        return {
            "n_tokens": sizes, "n_known": add((count > 0)[back].astype(np.int64)),
            "base_score": add(base[back]), "score": add(np.log10(chance)),
        }


#: Arrays of a context: tokens after it, and distinct words after it once, twice, more often.
CONTEXT = ("after", "once", "twice", "more")


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (before.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)


def _local(spark, name: str) -> str:
    path = fresh_path(spark, name)
    scheme, _, rest = path.partition("://")
    if rest and scheme != "file":
        raise ValueError(f"workers cannot map files of {path} into memory; name a mounted folder in spark.checkpoint.dir")
    path = "/" + (rest or path.removeprefix("file:")).lstrip("/")
    os.makedirs(path, exist_ok=True)
    return path


def _sizes(stored: DataFrame, shards: int) -> list[int]:
    found = {row["shard"]: row["size"] for row in stored.select("shard", "size").collect()}  # one number a shard
    return [found.get(s, 0) for s in range(shards)]


def fit(texts: DataFrame) -> Model:
    """The model of a table of texts (column ``text``, no nulls)."""
    spark = texts.sparkSession
    folder = _local(spark, "kneser-ney")
    volume = texts.agg(F.sum(F.octet_length("text") + 2)).first()[0] or 1
    word_shards, pair_shards = -(-volume // WORD_SHARD_BYTES), -(-volume // PAIR_SHARD_BYTES)
    texts = texts.select("text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            hashes, _ = token_hashes(batch.column("text").to_pylist())
            yield _blobs(*(lambda k, c: (k, [c]))(*np.unique(hashes, return_counts=True)), word_shards)

    def save_words(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, (counts,) = _merged(group["blob"], 1)
        _save(folder, f"words-keys-{key[0]}", keys)
        _save(folder, f"words-counts-{key[0]}", counts.astype("<u4"))
        return pd.DataFrame({"shard": [key[0]], "size": [len(keys)], "tokens": [int(counts.sum())]})

    stored = materialize(
        texts.mapInArrow(count_words, "shard bigint, blob binary").groupBy("shard")
        .applyInPandas(save_words, "shard bigint, size bigint, tokens bigint"), "lm-words",
    )
    tokens = stored.agg(F.sum("tokens")).first()[0] or 0
    words = Shards(folder, "words", _sizes(stored, word_shards))
    vocabulary = int(words.offsets[-1])
    if vocabulary + 2 >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")

    reader = Model(words, Shards(folder, "pairs", [0]), tokens, [0] * 4, [0] * 5)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            hashes, first = token_hashes(batch.column("text").to_pylist())
            if not len(hashes):
                continue
            word = reader.word_ids(hashes)
            before = np.empty_like(word)
            before[1:] = word[:-1]
            before[first] = vocabulary + 1
            keys, counts = np.unique(pair_keys(before, word), return_counts=True)
            yield _blobs(keys, [counts], pair_shards)

    def save_pairs(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, (counts,) = _merged(group["blob"], 1)
        _save(folder, f"pairs-keys-{key[0]}", keys)
        _save(folder, f"pairs-counts-{key[0]}", counts.astype("<u4"))
        before, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        before[before == vocabulary + 1] = vocabulary
        # What this shard adds to contexts and to words, by the shard of the word.
        one = np.ones_like(counts)
        ids = np.concatenate([before, word])
        parts = [counts, counts == 1, counts == 2, counts >= 3]
        values = [np.concatenate([p * one, 0 * one]) for p in parts] + [np.concatenate([0 * one, one])]
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1]))
        ids, values = ids[order][first], [np.add.reduceat(v[order], first) for v in values]
        shard = np.minimum(np.searchsorted(words.offsets, ids, side="right") - 1, word_shards)
        blobs = []
        for s in np.unique(shard).tolist():
            rows = shard == s
            blobs.append({
                "kind": "words", "part": s, "size": int(rows.sum()),
                "blob": ids[rows].astype("<u8").tobytes() + b"".join(v[rows].astype("<u4").tobytes() for v in values),
            })
        blobs.append({
            "kind": "pairs", "part": int(key[0]), "size": len(keys),
            "blob": np.array([(counts == k).sum() for k in (1, 2, 3, 4)], "<u8").tobytes(),
        })
        return pd.DataFrame(blobs)

    paired = materialize(
        texts.mapInArrow(count_pairs, "shard bigint, blob binary").groupBy("shard")
        .applyInPandas(save_pairs, "kind string, part bigint, size bigint, blob binary"), "lm-pairs",
    )
    own = paired.filter("kind = 'pairs'").select(F.col("part").alias("shard"), "size", "blob").collect()  # one row a shard
    pair_sizes = {row["shard"]: row["size"] for row in own}
    pairs = Shards(folder, "pairs", [pair_sizes.get(s, 0) for s in range(pair_shards)])
    pair_of = sum((np.frombuffer(row["blob"], "<u8") for row in own), np.zeros(4, np.uint64))

    def save_contexts(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids, sums = _merged(group["blob"], 5)
        size = 1 if key[0] == word_shards else words.sizes[key[0]]
        at = ids.astype(np.int64) - int(words.offsets[key[0]])
        for name, column in zip((*CONTEXT, "before"), sums):
            full = np.zeros(size, "<u4")
            full[at] = column
            _save(folder, f"words-{name}-{key[0]}", full)
        kinds = sums[4]
        return pd.DataFrame({"n": [[int((kinds == k).sum()) for k in (1, 2, 3, 4)] + [int((kinds >= 3).sum())]]})

    follow = materialize(
        paired.filter("kind = 'words'").select(F.col("part").alias("shard"), "blob").groupBy("shard")
        .applyInPandas(save_contexts, "n array<bigint>"), "lm-contexts",
    ).collect()  # five numbers a shard
    follow_of = np.sum([row["n"] for row in follow], axis=0).tolist() if follow else [0] * 5
    words.beyond = bool(follow)
    return Model(words, pairs, tokens, [int(n) for n in pair_of], follow_of)


def perplexity(
    docs: DataFrame, train: Column, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    The model learns from the rows where ``train`` is true. Scores are log10 probabilities of
    the words and the end of each text; perplexity is 10^(-score / n_tokens). A null text is
    empty and has its end only; repeated rows count and are scored each; null ids stay null; further
    columns are not read. Without training rows every word has the probability one.
    """
    learnt = docs.filter(train).select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    model = fit(learnt)
    kind = docs.schema[id_column].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            scored = model.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(scored[c]) for c in ("n_tokens", "n_known", "base_score", "score"))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    scored = id_and_text(docs, id_column, text).mapInArrow(
        score, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("bigint"))
