"""Token counts by finite-state transducers compiled from a byte-pair vocabulary.

Two machines run one after the other. A complete one over character classes cuts a text
into pre-tokens: texts are cut into chunks of equal length, every chunk gives a map from
each state at its start to the state at its end, the maps compose by a parallel prefix
scan, and every chunk then runs from its true state. The other one reads the bytes of a
pre-token; each of its transitions is annotated with the change of the number of tokens.
Its states are determinised when they are first reached and then kept.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm.common import code_points, id_and_text, slices

# Symbols of the class machine: letter, number, space and other white space (last of a run
# with text behind it, or not), anything else, an apostrophe that starts a contraction of one
# or two letters, and the end of a text.
L, N, SPACE_LAST, SPACE, WHITE_LAST, WHITE, OTHER, QUOTE1, QUOTE2, END = range(10)
UNKNOWN = 255
# States: nothing open; inside letters, numbers, others, white space; a space that joins what
# follows; one or two letters of a contraction to come.
START, IN_L, IN_N, IN_O, IN_W, JOIN, TAKE1, TAKE2 = range(8)
CHUNK = 64


def _class_machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, 1 if a pre-token starts), both by symbol * 8 + state."""
    opens = {L: IN_L, N: IN_N, SPACE_LAST: JOIN, SPACE: IN_W, WHITE_LAST: START, WHITE: IN_W,
             OTHER: IN_O, QUOTE1: TAKE1, QUOTE2: TAKE2, END: START}
    stays = {(L, IN_L): IN_L, (N, IN_N): IN_N, (SPACE, IN_W): IN_W, (WHITE, IN_W): IN_W,
             (L, JOIN): IN_L, (N, JOIN): IN_N, (L, TAKE1): START, (L, TAKE2): TAKE1}
    stays |= {(s, state): IN_O for s in (OTHER, QUOTE1, QUOTE2) for state in (IN_O, JOIN)}
    step, starts = np.zeros(80, np.uint8), np.zeros(80, np.uint8)
    for symbol in range(10):
        for state in range(8):
            inside = (symbol, state) in stays
            step[symbol * 8 + state] = stays[symbol, state] if inside else opens[symbol]
            starts[symbol * 8 + state] = not inside and symbol != END
    return step, starts


STEP, STARTS = _class_machine()
#: The code points that count as white space, from the Unicode property of that name.
WHITE_SPACE = "\t\n\v\f\r\x20\x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"


def class_table() -> np.ndarray:
    """The class symbol of every code point, ``SPACE`` and ``WHITE`` not yet told apart by place."""
    table = np.full(0x110000, OTHER, np.uint8)
    table[[c for c in code_points("C") if unicodedata.category(chr(c)) == "Cn"]] = UNKNOWN
    table[code_points("L")] = L
    table[code_points("N")] = N
    table[[ord(c) for c in WHITE_SPACE]] = WHITE
    table[0x20] = SPACE
    return table


def compose(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """State maps: row by row, what ``then`` makes of the states that ``first`` leads to."""
    return np.take_along_axis(then, first.astype(np.intp), axis=1)


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive scan of state maps by doubling steps."""
    maps, reach = maps.copy(), 1
    while reach < len(maps):
        maps[reach:] = compose(maps[:-reach], maps[reach:])
        reach *= 2
    return maps


def boundaries(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, for texts joined by code point 0x10FFFF + 1 as their end."""
    end = codes == 0x110000
    symbols = table[np.where(end, 0, codes)]
    symbols[end] = END
    space = (symbols == SPACE) | (symbols == WHITE)
    text_next = np.zeros(len(codes), bool)
    text_next[:-1] = ~space[1:] & ~end[1:]
    last = space & text_next
    symbols[last] -= 1  # SPACE_LAST and WHITE_LAST stand before SPACE and WHITE
    quotes = np.flatnonzero(codes == 0x27)
    if len(quotes):
        ahead = np.concatenate([codes, [0x110000, 0x110000]])
        one, two = ahead[quotes + 1], ahead[quotes + 2]
        symbols[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE1
        pairs = [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
        symbols[quotes[pairs[0] | pairs[1] | pairs[2]]] = QUOTE2

    chunks = -(-len(symbols) // CHUNK)
    padded = np.full(chunks * CHUNK, END, np.uint8)
    padded[: len(symbols)] = symbols
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T).astype(np.intp) * 8
    maps = np.tile(np.arange(8, dtype=np.uint8), (chunks, 1))
    for column in columns:
        maps = STEP[column[:, None] + maps]
    state = np.zeros(chunks, np.uint8)
    state[1:] = prefix_scan(maps)[:-1, START]
    flags = np.empty((CHUNK, chunks), np.uint8)
    for place, column in enumerate(columns):
        at = column + state
        flags[place] = STARTS[at]
        state = STEP[at]
    return np.flatnonzero(flags.T.reshape(-1)[: len(symbols)])


class PairTransducer:
    """Reads bytes, and says how many tokens byte-pair merging makes of them.

    The last token of every prefix is the only one whose join with the token before it the
    merges leave alone. A state holds, for each place where a token that is still being read may
    have begun, what has been read of it, the token before it, and the count there relative to
    the present one. That is all that later bytes depend on.
    """

    MAX_KEPT = 1_500_000

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in merges}
        self.prefixes = {token[:i] for token in self.tokens for i in range(1, len(token))}
        self.joins: dict[tuple[bytes, bytes], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [((b"", None, 0),)]
        self.numbers = {self.states[0]: 0}
        self.step: dict[int, int] = {}

    def merge(self, data: bytes) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 30), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            pair, merged, i = (parts[at], parts[at + 1]), [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    merged.append(pair[0] + pair[1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def joined(self, left: bytes, right: bytes) -> bool:
        known = self.joins.get((left, right))
        if known is None:
            known = self.joins[left, right] = self.merge(left + right) == [left, right]
        return known

    def compile(self, number: int, byte: int) -> int:
        """A new transition: the next state's number times 64, plus the count's change plus 32."""
        read, after = bytes([byte]), None
        grown = [(piece + read, before, count) for piece, before, count in self.states[number]]
        for piece, before, count in grown:
            if piece in self.tokens and (before is None or self.joined(before, piece)):
                change, after = count + 1, piece
                break
        state = tuple((p, b, c - change) for p, b, c in grown if p in self.prefixes) + ((b"", after, 0),)
        target = self.numbers.setdefault(state, len(self.states))
        if target == len(self.states):
            self.states.append(state)
        self.step[number << 8 | byte] = value = target << 6 | (change + 32)
        return value

    def count(self, data: bytes) -> int:
        state = tokens = 0
        step = self.step
        for byte in data:
            value = step.get(state << 8 | byte)
            if value is None:
                value = self.compile(state, byte)
            state = value >> 6
            tokens += (value & 63) - 32
        if len(step) > self.MAX_KEPT or len(self.joins) > self.MAX_KEPT:
            self.joins.clear()
            self.reset()
        return tokens


def read_vocabulary(path: str) -> tuple[list[tuple[bytes, bytes]], list[str]]:
    """(merges as bytes, special strings) of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    back = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
    as_bytes = lambda s: bytes(back[c] for c in s)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]]
    special = [t["content"] for t in parsed["added_tokens"] if t["special"]]
    return [(as_bytes(a), as_bytes(b)) for a, b in pairs], special


class _Words(dict):
    """Token counts of pre-tokens, filled as they are asked for."""

    def __init__(self, pairs: PairTransducer):
        super().__init__()
        self.pairs = pairs

    def __missing__(self, word: str) -> int:
        n = self[word] = self.pairs.count(word.encode("utf-8", "surrogatepass"))
        return n


class TokenCounter:
    """Counts tokens of texts; what it compiles is kept, and dropped when it grows large."""

    MAX_WORDS = 400_000

    def __init__(self, path: str):
        self.path = path
        merges, self.special = read_vocabulary(path)
        self.pairs = PairTransducer(merges)
        self.table = class_table()
        self.words = _Words(self.pairs)

    def learn_unknown(self, codes: np.ndarray) -> None:
        """Classes of characters that the library may know and Python does not."""
        if codes.max(initial=0) < 0x378:
            return
        found = codes[codes < 0x110000]
        if not (self.table[found] == UNKNOWN).any():
            return
        cut = Tokenizer.from_file(self.path).pre_tokenizer.pre_tokenize_str
        for c in np.unique(found[self.table[found] == UNKNOWN]).tolist():
            self.table[c] = L if len(cut("a" + chr(c))) == 1 else N if len(cut("1" + chr(c))) == 1 else OTHER

    def count(self, texts: list[str]) -> list[int]:
        """Special strings count as one token and part what stands around them."""
        pieces, owners, totals = [], [], [0] * len(texts)
        pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        for i, text in enumerate(texts):
            parts = pattern.split(text) if pattern and any(s in text for s in self.special) else [text]
            totals[i] += len(parts) - 1
            pieces += parts
            owners += [i] * len(parts)
        encoded = [p.encode("utf-32-le", "surrogatepass") for p in pieces]
        codes = np.frombuffer((0x110000).to_bytes(4, "little").join([*encoded, b""]), np.uint32)
        self.learn_unknown(codes)
        starts = boundaries(codes, self.table)
        stops = np.flatnonzero(codes == 0x110000)
        owner = np.searchsorted(stops, starts)
        ends = np.minimum(np.append(starts[1:], len(codes)), stops[owner]) if len(starts) else starts
        whole = "\0".join([*pieces, ""])
        cut = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        words = self.words
        counts = np.fromiter(map(words.__getitem__, cut), np.int64, len(cut))
        per_piece = np.bincount(owner, counts, len(pieces)).astype(np.int64).tolist()
        for text, n in zip(owners, per_piece):
            totals[text] += n
        if len(words) > self.MAX_WORDS:
            words.clear()
        return totals


_counters: dict[str, TokenCounter] = {}


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 1024, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``.

    ``vocabulary`` is a path that every worker can open. Null and empty texts have no tokens,
    repeated rows give repeated results, null ids stay null, further columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _counters:
            _counters[vocabulary] = TokenCounter(vocabulary)
        counter = _counters[vocabulary]
        for batch in slices(batches, "text", 4 << 20):
            tokens = pa.array(counter.count(batch.column("text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.compute.binary_length(batch.column("text")).cast(pa.int64()), tokens],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    counted = id_and_text(docs, id_column, text).mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
