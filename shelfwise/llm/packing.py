"""Packing by lexical retrieval: a seed document and its unused neighbours share a sequence.

Documents are dealt to shards by hash; the number of shards follows the volume of text, so a
shard, its inverted index and its packing stay bounded. In a shard every document is scored by
BM25 over all of the seed's token ids; each window starts with the next unused document and is filled greedily
with its best unused neighbours. The last one is cut where the window ends, and what is left
of it is the next seed, so that only the last window of a shard needs padding.
"""

from __future__ import annotations

import codecs
import json
import re
import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import character_class, give_back, held, id_and_text

#: Characters of text in a shard, on average.
SHARD_CHARS = 8_000_000
K1, B = 1.2, 0.75
#: Tokens in more than one of so many documents of a shard have their weights in dense rows.
DENSE = 4
#: Used documents leave the index when the others are less than this share of it.
NARROW = 0.8
#: Characters of text whose words are looked up together.
TOGETHER = 1 << 23
#: Characters of text that are cut into words at a time, and distinct words that are looked up at a time.
BLOCK, WORDS = 1 << 19, 1 << 15
#: Pieces that the library gets at a time.
PIECES = 10_000


class WordIds:
    """Token ids of texts, each distinct word once. The ids of pieces of words are kept in two generations: those of
    the texts at hand, and those of the texts before."""

    MAX_WORDS = 400_000
    #: Texts with these go to the library whole: special strings, white space that only one
    #: of both sides knows, and the capital with a two-character lower case.
    _ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f", "İ")

    def __init__(self, path: str):
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        size = self.whole.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words_only = tokenizers.Tokenizer(self.whole.model)
        self.words_only.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
        letter, number = character_class("L"), character_class("N")
        self.piece = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^\\s{letter}{number}]+")
        self.plain = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\\sa-z0-9]+")  # the same for ASCII
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in printable]
        letters = {b: chr(256 + i) for i, b in enumerate(hidden)}
        # The letter for each byte. No piece holds a blank, which parts them.
        self.bytes = "".join(" " if b == 32 else letters.get(b, chr(b)) for b in range(256))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(pieces), PIECES):
            part = " ".join(pieces[at : at + PIECES]).encode("utf-8", "replace")
            mapped = codecs.charmap_decode(part, "strict", self.bytes)[0]
            ids = np.array(self.words_only.encode_batch_fast([mapped], add_special_tokens=False)[0].ids)
            width = self.dtype.itemsize
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * width).tolist()
            raw = ids.astype(self.dtype).tobytes()
            out += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        return out

    def _split(self, word: str) -> str | None:
        """The pieces of a word with blanks between, none where the library may know newer characters."""
        if word[-1] in string.punctuation and word[:-1].isalpha():
            return f"{word[:-1]} {word[-1]}"
        if not word.isalnum() and not word.isprintable() and any(unicodedata.category(c) == "Cn" for c in word):
            return None
        return " ".join((self.plain if word.isascii() else self.piece).findall(word))

    def _learn(self, pieces: set[str]) -> None:
        young, old = self.young, self.old
        young.update({p: old[p] for p in pieces if p in old})
        new = [p for p in pieces if p not in young]
        young.update(zip(new, self._encode_pieces(new)))

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, as bytes."""
        if len(self.young) > self.MAX_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        young.update({word: old[word] for word in words if word in old})
        out = list(map(young.get, words))
        new = [at for at, ids in enumerate(out) if ids is None]
        needed = {words[at] for at in new if words[at].isalpha()}
        parted: list[str] = []  # strings, not lists: the collector of garbage does not look at them
        places = []
        for at in new:
            word = words[at]
            if word in needed:
                continue
            pieces = self._split(word) if word else ""
            if pieces:
                places.append(at)
                parted.append(pieces)
            else:
                out[at] = np.array(self.whole.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()
        needed.update(" ".join(parted).split(" ") if parted else ())
        self._learn(needed.difference(young))
        for at, pieces in zip(places, parted):
            out[at] = b"".join([young[p] for p in pieces.split(" ")])
        return [young[word] if ids is None else ids for word, ids in zip(words, out)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if 2 * len(self.young) > len(self.old):  # after few texts, those before them stay
            self.old, self.young = self.young, {}
        out: list[np.ndarray] = [None] * len(texts)
        waiting: list[int] = []
        size = 0
        for at, text in enumerate(texts):
            if any(odd in text for odd in self._ODD):
                ids = self.whole.encode(text, add_special_tokens=False).ids
                out[at] = np.array(ids, self.dtype)
                continue
            waiting.append(at)
            size += len(text)
            if size > TOGETHER:
                self._encode_words(texts, waiting, out)
                waiting, size = [], 0
        self._encode_words(texts, waiting, out)
        return out

    @staticmethod
    def _lower(text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")
        return text.lower()

    def _encode_words(self, texts: list[str], waiting: list[int], out: list[np.ndarray]) -> None:
        """Texts are cut and put together again block by block. Of all blocks at a time there are only the numbers
        of words, and the distinct words with their ids."""
        if not waiting:
            return
        blocks, numbers = [], []
        for block in self._blocks(texts, waiting):
            cut = pc.utf8_split_whitespace(pa.array([self._lower(texts[at]) for at in block], pa.large_string()))
            blocks.append((block, cut.offsets.to_numpy().copy()))
            numbers.append(cut.values.dictionary_encode())
            del cut
        numbers = pa.chunked_array(numbers).unify_dictionaries().chunks
        pa.default_memory_pool().release_unused()
        words = numbers[0].dictionary
        found, sizes = [], []
        for at in range(0, len(words), WORDS):
            part = self._word_ids(words.slice(at, WORDS).to_numpy(zero_copy_only=False).tolist())
            found.append(b"".join(part))
            sizes.append(np.fromiter(map(len, part), np.int64, len(part)) // self.dtype.itemsize)
            del part
        ids = np.frombuffer(b"".join(found), self.dtype)
        sizes = np.concatenate([np.zeros(0, np.int64), *sizes])
        starts = np.cumsum(sizes) - sizes
        for (block, offsets), number in zip(blocks, numbers):
            places = number.indices.to_numpy()
            lengths = sizes[places]
            upto = np.concatenate([[0], np.cumsum(lengths)])
            taken = np.repeat(starts[places] - upto[:-1], lengths)
            taken += np.arange(len(taken))
            joined = ids.take(taken)
            bounds = upto[offsets].tolist()
            for at, a, b in zip(block, bounds, bounds[1:]):
                out[at] = joined[a:b]

    @staticmethod
    def _blocks(texts: list[str], waiting: list[int]) -> Iterator[list[int]]:
        """Numbers of texts with about BLOCK characters together; a longer text stands alone."""
        block, size = [], 0
        for at in waiting:
            if block and size + len(texts[at]) > BLOCK:
                yield block
                block, size = [], 0
            block.append(at)
            size += len(texts[at])
        yield block


class Index:
    """BM25 over the token ids of a shard's documents."""

    def __init__(self, tokens: list[np.ndarray], vocabulary: int):
        terms, counts = zip(*(np.unique(t, return_counts=True) for t in tokens)) if tokens else ((), ())
        sizes = np.array([len(t) for t in terms])
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        term = np.concatenate(terms).astype(np.int64)
        doc = np.repeat(np.arange(len(tokens)), sizes)
        n, lengths = len(tokens), np.array([len(t) for t in tokens])
        tf = np.concatenate(counts).astype(np.float32)
        df = np.bincount(term, minlength=vocabulary)
        idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
        norm = (K1 * (1 - B + B * lengths / max(lengths.mean(), 1))).astype(np.float32)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        self.terms = term
        order = np.argsort(term.astype(np.uint32), kind="stable")
        self.posting_docs, self.posting_weights = doc[order], weight[order]
        self.term_start = np.concatenate([[0], np.cumsum(df)])
        self.docs = n
        self.live = np.arange(n)
        # Of frequent tokens, whole rows are added up faster than postings. There are at most DENSE times as many as
        # a document has distinct tokens on average.
        frequent = np.flatnonzero(df * DENSE > n)
        self.row = np.full(vocabulary, -1)
        self.row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), n), np.float32)
        for row, t in enumerate(frequent):
            span = slice(self.term_start[t], self.term_start[t + 1])
            self.dense[row, self.posting_docs[span]] = self.posting_weights[span]
        # A place for the rows of a seed, as fresh memory costs more than the sums.
        self.rows = np.empty_like(self.dense)

    def narrow(self, unused: np.ndarray) -> None:
        """Keep only unused documents as neighbours; scores of these stay what they are."""
        keep = unused[self.live]
        held_by = keep[self.posting_docs]
        self.posting_docs = (np.cumsum(keep) - 1)[self.posting_docs[held_by]]
        self.posting_weights = self.posting_weights[held_by]
        self.term_start = np.concatenate([[0], np.cumsum(held_by)])[self.term_start]
        self.dense = self.dense.compress(keep, axis=1)
        self.rows = np.empty_like(self.dense)
        self.live = self.live[keep]
        self.docs = len(self.live)

    def neighbours(self, seed: int) -> np.ndarray:
        """The score of every document in ``live``, at first all of the shard, for all tokens of the seed."""
        terms = self.terms[self.first[seed] : self.first[seed + 1]]
        rows = self.row[terms]
        dense = rows[rows >= 0]
        scores = self.dense.take(dense, axis=0, out=self.rows[: len(dense)], mode="clip").sum(axis=0, dtype=np.float64)
        rare = terms[rows < 0]
        if len(rare):
            start, sizes = self.term_start[rare], self.term_start[rare + 1] - self.term_start[rare]
            at = np.arange(sizes.sum()) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
            scores += np.bincount(self.posting_docs[at], self.posting_weights[at], self.docs)
        return scores


def pack_shard(tokens: list[np.ndarray], index: Index, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces that cover every token once."""
    lengths = [len(t) for t in tokens]
    unused = np.ones(len(tokens), bool)
    sequence, room, upcoming, left = 0, window, 0, len(tokens)
    rest: tuple[int, int] | None = None  # a cut document, and where it goes on
    while True:
        if rest is None:
            while upcoming < len(tokens) and not unused[upcoming]:
                upcoming += 1
            if upcoming == len(tokens):
                return
            rest = (upcoming, 0)
            unused[upcoming], left = False, left - 1
        seed, start = rest
        rest, scores = None, None
        while lengths[seed] - start >= room:
            yield seed, start, room, sequence, window - room
            start, sequence, room = start + room, sequence + 1, window
        if start == lengths[seed]:
            continue
        yield seed, start, lengths[seed] - start, sequence, window - room
        room -= lengths[seed] - start
        if 0 < left < NARROW * len(index.live):
            index.narrow(unused)
        scores = np.where(unused[index.live], index.neighbours(seed), 0)
        while True:
            at = int(scores.argmax())
            if scores[at] <= 0:
                break
            best = int(index.live[at])
            scores[at], unused[best], left = 0, False, left - 1
            if lengths[best] >= room:
                rest = (best, 0)
                break
            yield best, 0, lengths[best], sequence, window - room
            room -= lengths[best]


def pack(
    docs: DataFrame, vocabulary: str, window: int = 2048, end_id: int = 1,
    id_column: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the piece's token ids (array<int>). A null or empty text is the end id
    alone, repeated rows are documents of their own, null ids stay null, further columns are
    not read, an empty table gives no piece. ``vocabulary`` is a path that workers can open.
    """
    docs = id_and_text(docs, id_column, text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    chars = docs.agg(F.sum(F.length("text") + 1)).first()[0] or 1
    shards = -(-chars // SHARD_CHARS)
    dealt = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))

    def new_encoder() -> WordIds:
        give_back()  # what another operator kept in this worker
        return WordIds(vocabulary)

    def pack_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        encoder = held(("packing", vocabulary), new_encoder)
        give_back(collect=False)
        group = group.sort_values(["doc_id", "text"], ignore_index=True)
        end = np.array([end_id], encoder.dtype)
        bare = encoder.encode(group["text"].tolist())
        index = Index(bare, len(encoder.ends))
        tokens = [np.concatenate([t, end]) for t in bare]
        rows = list(pack_shard(tokens, index, window))
        doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*rows))
        pieces = [tokens[d][s : s + n] for d, s, n, _, _ in rows]
        out = pd.DataFrame({
            "doc_id": group["doc_id"].to_numpy()[doc], "start": start, "length": length,
            "ids_crc32": np.array([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces], np.int64),
            "doc_tokens": np.array([len(t) for t in tokens], np.int64)[doc],
            "sequence_id": int(key[0]) * (1 << 32) + sequence, "offset": offset,
        })
        if with_ids:
            out["ids"] = [p.astype("<u4") for p in pieces]
        return out

    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint" + ", ids array<int>" * with_ids
    )
    return dealt.groupBy("shard").applyInPandas(pack_group, schema)
