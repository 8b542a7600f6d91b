"""Groups of spelling variants: words one inserted, deleted or replaced code point apart.

Two words are compared inside dense tiles: blocks of words as padded matrices of code points,
one aligned left and one aligned right, give the common prefix and suffix of every pair of
two blocks; a pair is near if both together reach the longer length less one.

Which blocks meet follows from the place of the edit. Of a pair whose longer word has ``size`` code
points, it lies in a window [lo, hi) of places, and both words agree before and behind the
window: they meet in the group of (size, lo, hi, head, tail). Windows are halves of the word; a
group too large for a few tiles is parted again by halves of its window. A window of one place
holds words that differ there only. So no pair is lost, none is found twice, and no group grows.

Contracts: a null text has no words and a null id counts as empty text; equal rows count row by row;
other columns are left out; an empty table gives an empty one. Words may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.tables import materialize

RUN = r"[A-Za-zÀ-ÿ]+"
#: Least code points and least occurrences of a word, and one in how many runs loses a code point.
LEAST_LENGTH, LEAST_COUNT, DROP_ONE_IN = 7, 2, 31
#: A word's form must be so many times as frequent.
FORM_RATIO = 10
#: Words whose counts a task holds before it passes them on.
HELD_WORDS = 300_000
#: Most words of a group that meet in one task, rows of a shard, and rows and cells of a tile.
GROUP_WORDS, SHARD_ROWS, TILE_ROWS, TILE_CELLS = 2048, 100_000, 96, 1 << 21
WINDOW = ["size", "lo", "hi", "head", "tail"]
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _partial_counts(least_length: int) -> Callable:
    # Shorter runs cannot give a word that is long enough.
    runs = re.compile(RUN[:-1] + f"{{{least_length},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(list(held), pa.string()), "n": pa.array(held.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                for word, n in Counter(runs(text.as_py().translate(LOWER))).items():
                    h = zlib.crc32(f"{doc_id}:{word}".encode())
                    if h % DROP_ONE_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    return run


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of the texts, lower-cased, of some length and frequency."""
    empty = F.lit("")
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), empty).alias(n) for c, n in (("doc_id", "id"), ("text", "text"))))
    counts = plain.mapInArrow(_partial_counts(least_length), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _windows(rows: DataFrame, *bounds: tuple) -> DataFrame:
    """Rows (word, n, size) once per window of places, given as pairs of columns."""
    window = F.explode(F.array(*(F.struct(a.cast("int").alias("lo"), b.cast("int").alias("hi")) for a, b in bounds)))
    rows = rows.select("word", "n", "size", window.alias("window")).select("word", "n", "size", "window.*")
    head, tail = F.col("word").substr(F.lit(1), F.col("lo")), F.col("size") - F.col("hi")
    kept = F.when(tail > 0, F.col("word").substr(F.length("word") - tail + 1, tail)).otherwise("")
    return rows.withColumn("head", head).withColumn("tail", kept)


def meeting_groups(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """Words (word, n) in the groups where they meet near ones: adds size, lo, hi, head, tail.

    A word is of the group's size or one shorter. Groups of one word are left out, and those of
    more than ``group_words`` have windows of one place.
    """
    length = F.length("word")
    sized = words.withColumn("size", F.explode(F.array(length, length + 1)))
    half = F.floor(F.col("size") / 2)
    open_, done = _windows(sized, (F.lit(0), half), (half, F.col("size"))), []
    while True:
        open_ = materialize(open_, "windows")
        counts = open_.groupBy(*WINDOW).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        counts = materialize(counts, "window-counts")
        large = (F.col("members") > group_words) & (F.col("hi") - F.col("lo") > 1)
        done.append(open_.join(counts.filter(~large).drop("members"), WINDOW))
        hot = counts.filter(large).drop("members")
        if hot.isEmpty():
            break
        middle = F.floor((F.col("lo") + F.col("hi")) / 2)
        open_ = _windows(open_.join(hot, WINDOW), (F.col("lo"), middle), (middle, F.col("hi")))
    groups = done[0]
    for more in done[1:]:
        groups = groups.unionByName(more)
    return groups


class Tiles:
    """Code points of words in order of group: aligned left, and backwards from the end."""

    def __init__(self, words: pa.Array, group: np.ndarray, low: np.ndarray, high: np.ndarray, size: np.ndarray):
        self.group, self.low, self.high, self.size = group, low, high, size
        self.length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int32)
        self.codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]

    def matrix(self, rows: slice, width: int, backwards: bool) -> np.ndarray:
        """Padded with 0, which no word holds."""
        place = np.arange(width)[None, :]
        start, length = self.start[rows, None], self.length[rows, None]
        at = start + (length - 1 - place if backwards else place)
        return np.where(place < length, self.codes[np.clip(at, 0, len(self.codes) - 1)], 0)

    def common(self, left: slice, right: slice, width: int, backwards: bool) -> np.ndarray:
        """Length of the common prefix, or suffix, of each pair of two blocks; padding differs."""
        a, b = self.matrix(left, width + 1, backwards), self.matrix(right, width + 1, backwards)
        differ = a[:, None, :] != b[None, :, :]
        differ[:, :, width] = True
        return np.minimum(differ.argmax(axis=2), np.minimum(self.length[left, None], self.length[None, right]))

    def near(self, left: slice, right: slice) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of two blocks one edit apart whose edit lies in their group's window."""
        width = int(max(self.length[left].max(), self.length[right].max()))
        prefix = self.common(left, right, width, False)
        longer = np.maximum(self.length[left, None], self.length[None, right])
        apart = np.abs(self.length[left, None] - self.length[None, right])
        match = (self.group[left, None] == self.group[None, right]) & (apart <= 1)
        match &= (longer == self.size[left, None]) & (self.low[left, None] <= prefix) & (prefix < self.high[left, None])
        if not match.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        suffix = self.common(left, right, width, True)
        match &= prefix + suffix >= longer - 1
        if left == right:
            match = np.triu(match, 1)
        a, b = np.nonzero(match)
        return a + left.start, b + right.start

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All near pairs: each block meets itself and those behind it that its last group reaches."""
        blocks, first = [], 0
        while first < len(self.group):
            # The widest of the next rows bounds the rows of a tile.
            width = int(self.length[first : first + TILE_ROWS].max()) + 1
            rows = max(1, min(TILE_ROWS, int((TILE_CELLS / width) ** 0.5)))
            blocks.append(slice(first, min(first + rows, len(self.group))))
            first += rows
        for i, left in enumerate(blocks):
            yield self.near(left, left)
            for right in blocks[i + 1 :]:
                if self.group[right.start] != self.group[left.stop - 1]:
                    break
                yield self.near(left, right)


def _near_words(table: pa.Table) -> pa.Table:
    """Both directions of every near pair of a shard of groups."""
    table = table.sort_by([(name, "ascending") for name in (*WINDOW, "word")]).combine_chunks()
    changes = np.zeros(table.num_rows, bool)
    for name in WINDOW:
        column = table[name].combine_chunks()
        changes[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    words, n = table["word"].combine_chunks(), table["n"].combine_chunks()
    tiles = Tiles(words, np.cumsum(changes), *(table[name].to_numpy() for name in ("lo", "hi", "size")))
    found = [pair for pair in tiles.pairs() if len(pair[0])]
    a = np.concatenate([np.zeros(0, np.int64), *(x for pair in found for x in pair)])
    b = np.concatenate([np.zeros(0, np.int64), *(x for pair in found for x in pair[::-1])])
    return pa.table({"word": words.take(pa.array(a)), "near": words.take(pa.array(b)), "near_n": n.take(pa.array(b))})


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, near, near_n) for all words (word, n) one edit apart, both ways."""
    groups = materialize(meeting_groups(words, group_words), "meeting-groups")
    shards = max(1, -(-groups.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64(*WINDOW), F.lit(shards))
    return groups.groupBy(shard.alias("shard")).applyInArrow(_near_words, "word string, near string, near_n bigint")


def _rooted(forms: DataFrame, ratio: int) -> DataFrame:
    """(word, root) for words (word, form) with a form, by doubling steps.

    Counts grow by ``ratio`` from a word to its form, so a chain has as many steps as a bigint has digits at most.
    """
    paths = forms.select("word", F.col("form").alias("root"))
    steps = 1
    while ratio**steps < 1 << 63:
        paths = materialize(paths, "roots")
        beyond = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if paths.join(beyond, "root", "left_semi").isEmpty():
            break
        paths = paths.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        steps *= 2
    return paths


def variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with its most frequent near word, if that is
    ``ratio`` times as frequent, and the end of the chain of forms."""
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word, else chains can be circles")
    known = materialize(words(docs, least_length, least_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near")))
    near = near_words(known).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form = F.col("n").cast("decimal(20,0)") * ratio <= -F.col("best.order")
    joined = materialize(known.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(form, F.col("best.near")).alias("form"), F.when(form, -F.col("best.order")).alias("form_n"),
    ), "forms")
    roots = _rooted(joined.filter("form is not null"), ratio)
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The query in DuckDB. The checksum's table follows from its polynomial; words have code points
#: below 256 only, so those from 192 on are two bytes.
SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(id || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM counted, crc
), results AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 7 GROUP BY ALL HAVING sum(n) >= 2
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), shorter AS (
  SELECT word, n, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM places
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(struct_pack(near := near, n := near_n), struct_pack(a := -near_n, b := encode(near))) AS best FROM near GROUP BY ALL
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * w.n THEN best.near END AS form,
    CASE WHEN best.n >= 10 * w.n THEN best.n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chains c ON c.word = f.word AND c.next IS NULL
"""
