"""Toxicity by subword bags: a word is the average of the vectors of its character n-grams and of
itself, a text the average of its words, and a linear softmax reads the text's vector. Vectors
and softmax are trained together in numpy, so a misspelling that was never seen still
shares most of its n-grams, and thereby its vector, with the word it comes from.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import give_back, held, id_and_text, slices

BUCKETS, DIMENSIONS = 1 << 17, 4
SHORTEST, LONGEST = 3, 5
#: Rows of each class that the model is fitted on at most, chosen by hash.
SAMPLE_ROWS = 1500
#: Full-batch steps; the first step size; what each step takes off the length of every vector,
#: so that features that say nothing vanish.
EPOCHS, RATE, SHRINK = 120, 1.0, 0.003
#: A feature that fewer texts of the sample have is not fitted: it would only be learnt by heart.
MIN_TEXTS = 5
#: Words of one bag. A text's score is that of its most toxic bag: a few insults are as
#: visible in a long text as in a short one.
BAG = 128


def letters(word: str) -> str:
    """The word in lower case without what is not a letter or digit."""
    word = word.lower()
    return word if word.isalnum() else "".join(c for c in word if c.isalnum())


def features(word: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash buckets, weights) of the word itself and of its character n-grams."""
    if not word:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    edged = f"<{word}>"
    grams = dict.fromkeys(edged[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(edged) - n + 1))
    names = [f"={edged}", *grams]
    buckets = [xxhash.xxh3_64_intdigest(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in names]
    return np.array(buckets), np.full(len(names), 1 / len(names), np.float32)


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows; ``first`` are the offsets of segments, of which none is empty."""
    return np.add.reduceat(rows, first, axis=0)


class Model:
    def __init__(self, vectors: np.ndarray, direction: np.ndarray, bias: float):
        #: The softmax of two classes reads only the difference of their weights.
        self.weights = (vectors @ direction).astype(np.float32)
        self.bias = bias
        self.key = uuid.uuid4().hex

    def word(self, word: str) -> float:
        buckets, weights = features(letters(word))
        return float(self.weights[buckets] @ weights)


def bags(text: str) -> list[list[str]]:
    words = text.split()
    count = max(1, -(-len(words) // BAG))
    size = -(-len(words) // count) if words else 1
    return [words[i : i + size] for i in range(0, len(words), size)] or [[]]


def train(texts: list[str], toxic: list[int]) -> Model:
    """Full-batch Adam on the bags of the texts. Of a toxic text the bag that scores highest
    at present carries the label, of a clean text all of them. Both classes weigh the same. Without
    rows of both classes every text gets the score that the share of toxic rows suggests."""
    vocabulary: dict[str, int] = {}
    bag_words, bag_text = [], []
    for number, text in enumerate(texts):
        for bag in bags(text):
            found = [w for w in map(letters, bag) if w]
            if found:
                bag_words.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in found]))
                bag_text.append(number)
    random = np.random.default_rng(7)
    vectors = random.normal(0, 0.02, (BUCKETS, DIMENSIONS)).astype(np.float32)
    direction = random.normal(0, 0.3, DIMENSIONS).astype(np.float32)
    if not bag_words or len(set(toxic)) < 2:
        return Model(vectors, np.zeros(DIMENSIONS, np.float32), float(np.log((sum(toxic) + 0.5) / (len(toxic) - sum(toxic) + 1.0))))

    # Features as flat arrays of 32 bits: the sample has millions of them.
    flat, sizes = array("i"), array("i")
    for w in vocabulary:
        buckets, _ = features(w)
        flat.extend(buckets.tolist())
        sizes.append(len(buckets))
    gram, gram_size = np.frombuffer(flat, np.int32), np.frombuffer(sizes, np.int32)
    gram_first = np.concatenate([[0], np.cumsum(gram_size)[:-1]])
    texts_with = np.zeros(BUCKETS, np.int32)
    bounds = np.searchsorted(bag_text, np.arange(len(texts) + 1))
    for low, high in zip(bounds, bounds[1:]):
        if high > low:
            own = np.unique(np.concatenate(bag_words[low:high]))
            texts_with[np.unique(np.concatenate([gram[gram_first[w] : gram_first[w] + gram_size[w]] for w in own]))] += 1
    # Features of too few texts keep their share of the average, as zeros.
    common = texts_with >= MIN_TEXTS
    spare = int(np.flatnonzero(~common)[0]) if (~common).any() else 0
    gram = np.where(common[gram], gram, np.int32(spare))
    gram_share = np.repeat((1 / gram_size).astype(np.float32), gram_size)[:, None]
    order = np.argsort(gram, kind="stable")
    used, used_first = np.unique(gram[order], return_index=True)
    sorted_share = gram_share[order]
    gram_word = np.repeat(np.arange(len(sizes), dtype=np.int32), gram_size)[order]
    position = np.searchsorted(used, gram).astype(np.int32)
    del order, gram

    bag_size = np.array([len(b) for b in bag_words])
    word = np.concatenate(bag_words)
    bag_first = np.concatenate([[0], np.cumsum(bag_size)[:-1]])
    word_order = np.argsort(word, kind="stable")
    word_first = np.unique(word[word_order], return_index=True)[1]
    word_bag = np.repeat(np.arange(len(bag_words)), bag_size)[word_order]

    owner = np.array(bag_text)
    label = np.array(toxic)[owner].astype(np.float32)
    owner_first = np.unique(owner, return_index=True)[1]
    balance = np.where(label > 0, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6))

    bias, moments = 0.0, {}

    def adam(name, value, gradient, step):
        mean, square = moments.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient * gradient
        moments[name] = mean, square
        return value - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)

    active = vectors[used] * common[used, None]
    for step in range(1, EPOCHS + 1):
        rows = active[position]
        rows *= gram_share
        words = _sums(rows, gram_first)
        vector = _sums(words[word], bag_first) / bag_size[:, None]
        logit = 20 * (vector @ direction) + bias
        chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        best = np.repeat(np.maximum.reduceat(logit, owner_first), np.diff(np.append(owner_first, len(owner))))
        # Early on every bag carries its text's label, later only those near the text's highest score.
        share = np.where(label > 0, np.exp(-np.clip(best - logit, 0, 30) * step / EPOCHS), 1.0)
        weight = balance * share
        weight = weight / weight.sum()
        error = (chance - label) * weight
        g_direction = 20 * (error @ vector) 
        g_vector = (20 * error / bag_size)[:, None] * direction[None, :]
        g_word = _sums(g_vector[word_bag], word_first)
        rows = g_word.astype(np.float32)[gram_word]
        rows *= sorted_share
        g_active = _sums(rows, used_first)
        del rows
        g_active[~common[used]] = 0
        # One step size for all vectors, or rare features would move as far as telling ones.
        state = moments.setdefault("vectors", [np.zeros_like(active), 0.0])
        state[0] = 0.9 * state[0] + 0.1 * g_active
        state[1] = 0.99 * state[1] + 0.01 * float((g_active**2).sum(axis=1).max())
        active = active - RATE * (state[0] / (1 - 0.9**step)) / np.sqrt(state[1] / (1 - 0.99**step) + 1e-30)
        norm = np.sqrt((active**2).sum(axis=1, keepdims=True)) + 1e-12
        active = active * np.maximum(0, 1 - SHRINK / norm)
        active = active.astype(np.float32)
        direction = adam("direction", direction, g_direction.astype(np.float32), step)
        bias = float(adam("bias", np.array(bias), np.array(error.sum()), step))
    vectors *= 0
    vectors[used] = active
    return Model(vectors, 20 * direction, bias)


def _scorer(shared) -> "Scorer":
    """The worker's scorer of a model, kept from task to task."""
    return held(("toxicity", shared.value.key), lambda: Scorer(shared.value))


class Scorer(dict):
    """Scores of texts; what words add is kept."""

    MAX_WORDS = 500_000

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > self.MAX_WORDS:
            self.clear()
        value = self[word] = self.model.word(word)
        return value

    def score(self, text: str) -> float:
        """The chance of the most toxic bag; a text without words has the score 0."""
        words = text.split()
        if not words:
            return 0.0
        values = np.fromiter(map(self.__getitem__, words), np.float32, len(words))
        count = -(-len(words) // BAG)
        size = -(-len(words) // count)
        first = np.arange(0, len(words), size)
        means = np.add.reduceat(values, first) / np.diff(np.append(first, len(words)))
        return float(1 / (1 + np.exp(-np.clip(means.max() + self.model.bias, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, rows: int = SAMPLE_ROWS) -> Model:
    """The model of at most ``rows`` labelled texts of each class where ``train_on`` (over
    doc_id) is true, chosen by a hash of the id. ``docs`` has doc_id and text, ``labels``
    doc_id and toxic; a null label is none, of repeated labels the largest counts."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(train_on)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.filter(F.col("toxic") == label).orderBy(*order).limit(rows) for label in (1, 0)]
    chosen = parts[0].unionByName(parts[1])  # two times ``rows`` ids at most
    sample = docs.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic").collect()
    sample.sort(key=lambda row: row["doc_id"])
    return train([row["text"] for row in sample], [int(row["toxic"] == 1) for row in sample])


def toxicity(
    docs: DataFrame, labels: DataFrame, train_on: Column, threshold: float = 0.7,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs``.

    Only text is scored. Null and empty texts have the score 0, repeated rows get
    repeated results, null ids stay null, further columns are not read. Without labels the
    score is one half.
    """
    plain = id_and_text(docs, id_column, text)
    model = fit(plain, labels, train_on)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per hash bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared)
        for batch in slices(batches, "text", 8 << 20):
            scores = [scorer.score(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])
        give_back()

    kind = docs.schema[id_column].dataType.simpleString()
    scored = plain.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(
    docs: DataFrame, labels: DataFrame, train_on: Column, threshold: float = 0.7, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(id_and_text(docs, id_column, text), labels, train_on))

    def score(texts: pd.Series) -> pd.Series:
        scorer = _scorer(shared)
        scores = pd.Series([scorer.score(t or "") for t in texts], dtype="float64")
        give_back()
        return scores

    return docs.filter(F.pandas_udf(score, "double")(F.col(text)) < threshold)
