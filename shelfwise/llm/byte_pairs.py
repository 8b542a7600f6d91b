"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are cut into pre-tokens. A block of texts keeps, in order of position, a code for each
pre-token and the list of its distinct words. The words, not their occurrences, are shuffled:
all blocks' copies of a word meet in one shard, are encoded once there, and the ids go back
to the blocks, which put them at the positions. A word in every text is one entry a block.
Decoding joins ids with the table of token bytes by its dense key.

Contracts: a null text counts as empty and has no ids; equal rows and null ids are encoded row
by row; other columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.llm.common import id_and_text
from shelfwise.sources.tables import materialize

#: Bytes of text in a block, beyond which the next text starts another; a longer text stands alone.
BLOCK_BYTES = 32 << 20
#: Words, counted once a block, that one task encodes.
SHARD_WORDS = 400_000
#: Words of more bytes are merged with a heap, in time n log n.
LONG_WORD = 64


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def token_bytes(path: str) -> pa.LargeBinaryArray:
    """The bytes of every id, at the place of the id; null where no token has it."""
    known = {rank: token for token, rank in ranks(path).items()}
    return pa.array([known.get(i) for i in range(max(known) + 1)], pa.large_binary())


def _ranges(characters: str) -> str:
    """The inside of a character class for characters in order."""
    points = np.array([*map(ord, characters)])
    first = np.flatnonzero(np.diff(points, prepend=-2) != 1)
    last = np.append(first[1:], len(points)) - 1
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(points[first], points[last]))


@cache
def splitters(pattern: str) -> tuple[Callable, Callable, int]:
    """Two splitters and the first code point where the two can differ.

    Both follow the pattern; the second one takes letters and numbers as the tokenizer library
    knows them, whose Unicode tables are of another year than those of the pattern module.
    """
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    exact, odd = pattern, 0x110000
    for group in (r"\p{L}", r"\p{N}"):
        library = tiktoken.Encoding("classes", pat_str=group, mergeable_ranks=single, special_tokens={})
        theirs = bytes(library.encode_ordinary(everything)).decode()
        ours = "".join(regex.findall(group, everything))
        odd = min([odd, *map(ord, set(theirs) ^ set(ours))])
        inside = _ranges(theirs)
        exact = regex.sub(r"(\[[^\]]*)" + regex.escape(group), lambda m, i=inside: m[1] + i, exact)
        exact = exact.replace(group, f"[{inside}]")
    return regex.compile(pattern).findall, regex.compile(exact).findall, odd


def merge(word: bytes, known: dict[bytes, int]) -> list[int]:
    """Ids of a word: the adjacent pair of lowest rank, the leftmost of equals, is merged first."""
    if word in known:
        return [known[word]]
    if len(word) > LONG_WORD:
        return _merge_long(word, known)
    parts = [word[i : i + 1] for i in range(len(word))]
    beyond = len(known) + 1
    scores = [known.get(a + b, beyond) for a, b in zip(parts, parts[1:])]
    while scores and (least := min(scores)) < beyond:
        i = scores.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i:
            scores[i - 1] = known.get(parts[i - 1] + parts[i], beyond)
        if i < len(scores):
            scores[i] = known.get(parts[i] + parts[i + 1], beyond)
    return [known[part] for part in parts]


def _merge_long(word: bytes, known: dict[bytes, int]) -> list[int]:
    n = len(word)
    # Ends of the part that starts at a place, and the start of the part before it.
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = bytearray([1]) * n
    longest = max(map(len, known))

    def rank(start: int) -> int | None:
        then = end[start]
        if then == n or end[then] - start > longest:
            return None
        return known.get(word[start : end[then]])

    queue = [(r, i, i + 2) for i in range(n - 1) if (r := rank(i)) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, stop = heapq.heappop(queue)
        if not alive[i] or end[i] == n or end[end[i]] != stop:
            continue
        alive[end[i]] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
        for start in (before[i], i):
            if start >= 0 and (r := rank(start)) is not None:
                heapq.heappush(queue, (r, start, end[end[start]]))
    return [known[word[i : end[i]]] for i in range(n) if alive[i]]


def _packed(values: np.ndarray, level: int = 3) -> bytes:
    """Numbers below 2**32 byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), level)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _packed_words(words: pa.BinaryArray) -> tuple[bytes, bytes]:
    """Lengths and bytes of binary values without nulls."""
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False)
    return _packed(lengths), zstandard.compress(b"".join(words.to_pylist()), 3)


def _unpacked_words(lengths: bytes, data: bytes) -> pa.BinaryArray:
    offsets = np.concatenate([[0], np.cumsum(_unpacked(lengths))]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(zstandard.decompress(data))]
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _places(order: np.ndarray) -> np.ndarray:
    """The place of every entry in an order."""
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))
    return places


def _blocks(pattern: str, ids: pa.DataType) -> Callable:
    def block(number: int, doc_ids: list, sizes: list, codes: array, words: dict) -> pa.RecordBatch:
        found = np.frombuffer(codes, np.uint32) if codes else np.zeros(0, np.uint32)
        counts = np.bincount(found, minlength=len(words))
        listed = pa.array([word.encode() for word in words], pa.binary())
        # Frequent words get small codes, and of equally frequent ones neighbours are alike: both compress well.
        order = np.lexsort((_places(pc.sort_indices(listed).to_numpy()), -counts))
        code = _places(order).astype(np.uint32)
        lengths, data = _packed_words(listed.take(pa.array(order)))
        return pa.record_batch({
            "block": pa.array([f"{TaskContext.get().partitionId()}-{number}"]),
            "doc_ids": pa.array([doc_ids], pa.list_(ids)),
            "sizes": [_packed(np.array(sizes))],
            "codes": [_packed(code[found], 9)],
            "words": pa.array([len(words)], pa.int64()),
            "lengths": [lengths],
            "bytes": [data],
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, exact, odd = splitters(pattern)
        first_odd_byte = chr(odd).encode()[0]
        number = size = 0
        doc_ids, sizes, codes, words = [], [], array("I"), defaultdict()
        words.default_factory = words.__len__
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                data = text.as_buffer()
                if doc_ids and size + data.size > BLOCK_BYTES:
                    yield block(number, doc_ids, sizes, codes, words)
                    number, size = number + 1, 0
                    doc_ids, sizes, codes, words = [], [], array("I"), defaultdict()
                    words.default_factory = words.__len__
                size += data.size
                far = data.size and np.frombuffer(data, np.uint8).max() >= first_odd_byte
                found = (exact if far else plain)(text.as_py())
                codes.extend(map(words.__getitem__, found))
                doc_ids.append(doc_id)
                sizes.append(len(found))
        if doc_ids:
            yield block(number, doc_ids, sizes, codes, words)

    return run


def _dealt(shards: int) -> Callable:
    """The words of every block by shard, with their codes in rising order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = _unpacked_words(row["lengths"], row["bytes"])
                digests = [hashlib.blake2b(word, digest_size=4).digest() for word in words.to_pylist()]
                shard = np.frombuffer(b"".join(digests), "<u4") % shards
                order = np.argsort(shard, kind="stable")
                for codes in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    if not len(codes):
                        continue
                    lengths, data = _packed_words(words.take(pa.array(codes)))
                    yield pa.record_batch({
                        "shard": pa.array([int(shard[codes[0]])], pa.int64()),
                        "block": pa.array([row["block"]]),
                        "gaps": [_packed(np.diff(codes, prepend=0))],
                        "lengths": [lengths],
                        "bytes": [data],
                    })

    return run


def _encoded_words(path: str) -> Callable:
    """Of a shard's words from all blocks: each distinct one is encoded once, and the ids
    join the blocks' entries."""

    def run(table: pa.Table) -> pa.Table:
        known = ranks(path)
        parts = [_unpacked_words(*row) for row in zip(table["lengths"].to_pylist(), table["bytes"].to_pylist())]
        entries = pa.concat_arrays(parts).dictionary_encode()
        ids = pa.array([merge(word, known) for word in entries.dictionary.to_pylist()], pa.list_(pa.uint32()))
        counts, values, first = [], [], 0
        for part in parts:
            mine = ids.take(entries.indices.slice(first, len(part)))
            counts.append(_packed(mine.value_lengths().to_numpy(zero_copy_only=False)))
            values.append(_packed(mine.flatten().to_numpy(zero_copy_only=False)))
            first += len(part)
        return pa.table({"block": table["block"], "gaps": table["gaps"], "counts": counts, "ids": values})

    return run


def _assembled(block: pa.Table, found: pa.Table) -> pa.Table:
    """The texts of a block with the ids of their words at the words' positions: doc_id, ids."""
    row = block.to_pylist()[0]
    counts = np.zeros(row["words"], np.int64)
    codes, values = [], []
    for part in found.to_pylist():
        code = np.cumsum(_unpacked(part["gaps"]).astype(np.int64))
        counts[code] = _unpacked(part["counts"])
        codes.append(np.repeat(code, counts[code]))
        values.append(_unpacked(part["ids"]))
    if codes:
        # Ids in order of code: shards hold their codes in order, and a code's ids are together.
        order = np.argsort(np.concatenate(codes), kind="stable")
        values = np.concatenate(values)[order].astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(np.asarray(values, np.int32)))
    positions = _unpacked(row["codes"])
    flat = lists.take(pa.array(positions)).flatten()
    ends = np.concatenate([[0], np.cumsum(counts[positions])])
    sizes = np.concatenate([[0], np.cumsum(_unpacked(row["sizes"]).astype(np.int64))])
    ids = pa.ListArray.from_arrays(pa.array(ends[sizes].astype(np.int32)), flat)
    return pa.table({"doc_id": block["doc_ids"].combine_chunks().flatten(), "ids": ids})


def _texts(docs: DataFrame, path: str, pattern: str, finish: Callable[[pa.Table], pa.Table], *fields: T.StructField) -> DataFrame:
    """What ``finish`` makes of each block's texts (doc_id, ids), with the columns doc_id and ``fields``."""
    docs = id_and_text(docs)
    id_field = docs.schema["doc_id"]
    id_name = id_field.dataType.simpleString()
    blocks = materialize(
        docs.mapInArrow(
            _blocks(pattern, to_arrow_type(id_field.dataType)),
            f"block string, doc_ids array<{id_name}>, sizes binary, codes binary, words bigint, lengths binary, bytes binary",
        ),
        "word-blocks",
    )
    entries = blocks.agg(F.sum("words").alias("n")).first()["n"] or 0
    shards = max(1, -(-entries // SHARD_WORDS))
    found = (
        blocks.filter("words > 0").select("block", "lengths", "bytes")
        .mapInArrow(_dealt(shards), "shard bigint, block string, gaps binary, lengths binary, bytes binary")
        .groupBy("shard")
        .applyInArrow(_encoded_words(path), "block string, gaps binary, counts binary, ids binary")
    )
    texts = blocks.select("block", "doc_ids", "sizes", "codes", "words").groupBy("block")
    return texts.cogroup(found.groupBy("block")).applyInArrow(
        lambda block, words: finish(_assembled(block, words)), T.StructType([T.StructField("doc_id", id_field.dataType), *fields])
    )


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Columns ``doc_id`` and ``ids`` (array of int), one row per row of ``docs``.

    ``path`` names a file of ranks that workers can read; ``pattern`` gives the pre-tokens.
    """
    return _texts(docs, path, pattern, lambda table: table, T.StructField("ids", T.ArrayType(T.IntegerType())))


def joined_bytes(ids: pa.Array, table: pa.LargeBinaryArray) -> bytes:
    """The bytes of ids one behind the other; an id without a token is an error."""
    tokens = table.take(ids)
    if tokens.null_count:
        raise ValueError("ids without a token in the rank file")
    return b"".join(tokens.to_pylist()) if tokens.offset else _data(tokens)


def _data(tokens: pa.LargeBinaryArray) -> bytes:
    _, offsets, data = tokens.buffers()
    if not len(tokens) or data is None:
        return b""
    ends = np.frombuffer(offsets, np.int64, len(tokens) + 1)
    return data[ends[0] : ends[-1]].to_pybytes()


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with the bytes that the ids stand for, ``decoded``.

    The token table has a row per id of the rank file, whatever the corpus, so it goes to every task.
    Null ids give null bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in batches:
            decoded = [joined_bytes(ids.values, table) if ids.is_valid else None for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"])

    encoded = encoded.select("doc_id", "ids")
    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs`` the number and digest of its ids, and the digest of the bytes that they decode to:
    doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids), decoded_sha256.

    As ``decode`` of ``encode``, but ids do not leave the task that puts them together.
    """

    def digests(texts: pa.Table) -> pa.Table:
        table, ids = token_bytes(path), texts["ids"].combine_chunks()
        return pa.table({
            "doc_id": texts["doc_id"],
            "n_tokens": pc.cast(pc.list_value_length(ids), pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(row.values.to_numpy().astype("<u4").tobytes()).hexdigest() for row in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(joined_bytes(row.values, table)).hexdigest() for row in ids], pa.string()),
        })

    digest = [T.StructField(name, T.StringType()) for name in ("ids_sha256", "decoded_sha256")]
    return _texts(docs, path, pattern, digests, T.StructField("n_tokens", T.LongType()), *digest)
