"""Near-duplicate groups: circulant MinHash, banding, exact Jaccard verification.

Two permutations make a whole signature: the first scatters a document's shingles over the
domain, the second ranks them, and coordinate k ranks them after a circular shift by k.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import broadcast_if_small, give_back, held, id_and_text, slices
from shelfwise.llm.components import connected_components
from shelfwise.operators.skew import hashed_chunk, triangle
from shelfwise.operators.topn import top_n
from shelfwise.sources.tables import materialize

WORDS = 5
#: Chance at most, of the bands and of the sketch each, that a pair at exactly the threshold is missed.
MISSED = 3e-7
#: A band of a pair at the threshold agrees with this chance at least, or has so many rows at most.
BAND_CHANCE, MOST_ROWS = 0.25, 16
#: Bits of the signature that travel with a document, in words of 64.
SKETCH_WORDS = 6
#: Near neighbours of a document that are verified before the rest.
FIRST_PARTNERS = 3
#: Buckets of more members are compared in blocks, by full sets, and not pair by pair.
SMALL_BUCKET = 24
#: Shingles of a chunk of documents, on average.
BLOCK_SHINGLES = 300_000

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows) for a threshold: 48 bands of 8 at 85, 50 bands of 6 at 80."""
    similarity = min(max(percent, 1), 99) / 100
    rows = min(MOST_ROWS, max(1, int(math.log(BAND_CHANCE) / math.log(similarity))))
    return math.ceil(math.log(MISSED) / math.log1p(-(similarity**rows))), rows


def most_distance(percent: int) -> int:
    """The largest distance of two sketches that a pair at the threshold may have. Each bit
    differs with a chance of (1 - similarity) / 2; beyond lies a binomial tail of MISSED at most."""
    bits, differs = 64 * SKETCH_WORDS, (1 - min(percent, 99) / 100) / 2
    tail = 0.0
    for distance in range(bits, -1, -1):
        tail += math.comb(bits, distance) * differs**distance * (1 - differs) ** (bits - distance)
        if tail > MISSED:
            return distance
    return 0


class _WordHashes(dict):
    MAX = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.MAX:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of five-word shingles; fewer words give one shingle of all."""
    # Of bytes, lower() and split() know the ASCII letters and the six ASCII white spaces only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = held("minhash", _WordHashes)
    hashed = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total += hashed[k : k + count] * _FACTORS[k]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xE7037ED1A0B428DB)
    total ^= total >> np.uint64(29)
    return np.unique(total)


def _permute(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A bijection of 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(15)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, size: int = 64 * SKETCH_WORDS) -> np.ndarray:
    """The circulant MinHash signature of a set that is not empty."""
    scattered = _permute((shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), 128):
        ranks = _permute(scattered[None, at : at + 128] + shifts, 0x21F0AAAD, 0xD35A2D97)
        np.minimum(least, ranks.min(axis=1), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different bands never meeting."""
    grid = sig[: bands * rows].astype(np.uint64).reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * _FACTORS[0]
    for column in grid.T:
        keys = (keys ^ column) * _FACTORS[1]
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], n_bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    size = max(n_bands * rows, 64 * SKETCH_WORDS)
    for batch in slices(batches, "text", 8 << 20):
        sizes, keys, bands, bits = [], [], [], []
        for text in batch.column("text").to_pylist():
            shingles = shingle_set(text)
            sizes.append(len(shingles))
            if not len(shingles):
                keys.append(None), bands.append(None), bits.append(None)
                continue
            sig = signature(shingles, size)
            keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            bands.append(band_keys(sig, n_bands, rows))
            bits.append(np.packbits((sig[: 64 * SKETCH_WORDS] & 1).astype(np.uint8)).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "set_key", "bands", "bits"],
        )
    give_back()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 8 << 20):
        sets = [shingle_set(text).view(np.int64) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"]
        )
    give_back()


def _distance(left: Column, right: Column) -> Column:
    parts = [F.bit_count(F.get(left, i).bitwiseXOR(F.get(right, i))) for i in range(SKETCH_WORDS)]
    return sum(parts[1:], parts[0])


def bucket_places(documents: DataFrame) -> DataFrame:
    """One row per document and band whose bucket has other members: band, next_band (the key of the
    band after it), doc_id, n_shingles, bits. ``documents`` has one row per class."""
    following = F.concat(F.slice("bands", F.lit(2), F.size("bands") - 1), F.slice("bands", 1, 1))
    keyed = documents.select(
        "doc_id", F.explode(F.arrays_zip(F.col("bands").alias("band"), following.alias("next_band"))).alias("key")
    ).select("doc_id", "key.band", "key.next_band")
    shared = keyed.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1").select("band")
    return keyed.join(shared, "band").join(documents.select("doc_id", "n_shingles", "bits"), "doc_id")


def _adjacent(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Neighbours in sorted order that share a bucket, with their sketch distance."""
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if last is not None:
            table = pa.concat_tables([last, table])
        last = table.slice(table.num_rows - 1)
        band, doc = (table.column(c).to_numpy() for c in ("band", "doc_id"))
        bits = table.column("bits").combine_chunks().flatten().to_numpy().reshape(-1, SKETCH_WORDS)
        at = np.flatnonzero((band[1:] == band[:-1]) & (doc[1:] != doc[:-1]))
        distance = np.bitwise_count(bits[at] ^ bits[at + 1]).sum(axis=1, dtype=np.int64)
        keep = distance <= most
        one, two = doc[at][keep], doc[at + 1][keep]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(distance[keep])],
            ["a", "b", "distance"],
        )


def sorted_neighbours(places: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each document the nearest of its neighbours when buckets are sorted by
    the next band's key, as in a forest of prefix trees. Linear in the places."""
    order = ["band", "next_band", "bits", "doc_id"]
    ordered = places.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    most = most_distance(percent)
    met = ordered.mapInArrow(lambda batches: _adjacent(batches, most), "a bigint, b bigint, distance bigint")
    met = met.groupBy("a", "b").agg(F.min("distance").alias("distance"))
    either = met.select(F.col("a").alias("doc_id"), F.col("b").alias("other"), "distance").union(
        met.select("b", "a", "distance")
    )
    chosen = top_n(either, ["doc_id"], [F.col("distance"), F.col("other")], FIRST_PARTNERS)
    return chosen.select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")).distinct()


def mixed_buckets(places: DataFrame, labels: DataFrame) -> DataFrame:
    """The places of buckets that hold several components, with the component of each document and
    the number of ``members`` and the smallest ``leader`` of its bucket. Others are done with."""
    component = labels.select(F.col("id").alias("doc_id"), "component")
    placed = places.drop("next_band").join(component, "doc_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "doc_id"))
    mixed = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("members"), F.min("doc_id").alias("leader"),
    )
    return placed.join(mixed.filter("low <> high").select("band", "members", "leader"), "band")


def pairs_of_small(mixed: DataFrame, percent: int) -> DataFrame:
    """(a, b) with a < b that share a small bucket, lie in different components, and whose sizes and
    sketches allow the similarity. A place meets fewer than SMALL_BUCKET others."""
    placed = mixed.filter(F.col("members") <= SMALL_BUCKET).drop("members", "leader")
    left = placed.select("band", *[F.col(c).alias(f"{c}_a") for c in placed.columns if c != "band"])
    right = placed.select("band", *[F.col(c).alias(f"{c}_b") for c in placed.columns if c != "band"])
    small, large = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    met = left.join(
        right,
        (left["band"] == right["band"]) & (F.col("doc_id_a") < F.col("doc_id_b"))
        & (F.col("component_a") != F.col("component_b")) & (100 * small >= percent * large)
        & (_distance(F.col("bits_a"), F.col("bits_b")) <= most_distance(percent)),
    )
    return met.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct()


def block_links(near: tuple[np.ndarray, list], far: tuple[np.ndarray, list], same: bool, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two chunks of documents, or inside one: an inverted
    index of the second chunk counts what each document of the first has in common with it."""
    ids, sets = far
    sizes = np.array([len(s) for s in sets])
    shingle, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    roots = {int(i): int(i) for i in (*near[0], *ids)}

    def root(i: int) -> int:
        while roots[i] != i:
            roots[i] = i = roots[roots[i]]
        return i

    links = []
    for at, (one, own) in enumerate(zip(near[0].tolist(), near[1])):
        first, stop = np.searchsorted(shingle, own, "left"), np.searchsorted(shingle, own, "right")
        hit = np.flatnonzero(stop > first)
        if not len(hit):
            continue
        common = np.bincount(np.concatenate([owner[a:b] for a, b in zip(first[hit], stop[hit])]), minlength=len(sets))
        if same:
            common[: at + 1] = 0
        linked = np.flatnonzero((common > 0) & (100 * common >= percent * (sizes + len(own) - common)))
        for two in ids[linked].tolist():
            a, b = root(one), root(two)
            if a != b:
                roots[max(a, b)] = min(a, b)
                links.append((min(one, two), max(one, two)))
    return links


def links_of_large(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what is connected by pairs inside large buckets.

    Overlapping large buckets form a knot. A knot is cut into chunks by volume, any two
    chunks meet in one task, and of the links found there by full sets a spanning forest leaves it.
    """
    placed = mixed.filter(F.col("members") > SMALL_BUCKET)
    stars = placed.select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct()
    knots = connected_components(stars).select(F.col("id").alias("doc_id"), F.col("component").alias("knot"))
    described = knots.join(placed.select("doc_id", "n_shingles").distinct(), "doc_id")
    volume = described.groupBy("knot").agg(F.sum("n_shingles").alias("volume"))
    dealt = described.drop("n_shingles").join(volume, "knot")
    chunks = F.ceil(F.col("volume") / BLOCK_SHINGLES)
    blocks = triangle(dealt, hashed_chunk(chunks, "doc_id"), chunks).drop("volume")
    filled = blocks.join(sets, "doc_id")

    def link(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        sides = []
        for chunk in (key[1], key[2]):
            rows = group[group["chunk"] == chunk]
            sides.append((rows["doc_id"].to_numpy(), [np.asarray(s) for s in rows["shingles"]]))
        found = block_links(*sides, key[1] == key[2], percent) if all(len(side[1]) for side in sides) else []
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return filled.groupBy("knot", "lo", "hi").applyInPandas(link, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity."""
    sides = [
        sets.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"set_{name}")) for name in ("a", "b")
    ]
    both = pairs.select("a", "b").join(sides[1], "b").join(sides[0], "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def near_duplicates(
    docs: DataFrame, percent: int = 85, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Documents without a word, and rows without an id, are linked with nothing; the latter
    have a null component and are kept. Repeated rows give repeated results. Rows that share an id
    but not a text are one document: it is linked with whatever any of its texts is linked with. Further
    columns are not read. Ids must be whole numbers.

    Documents with equal sets become one class by a hash of the set. For every class its near
    neighbours in sorted buckets are verified first. Then only buckets of several components matter:
    in small ones the pairs across components are verified, large ones are compared block by block.
    """
    plain = id_and_text(docs, id_column, text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    digest = F.md5(F.col("text").cast("binary"))
    texts = plain.filter("doc_id is not null").groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    if texts.filter("low <> high").isEmpty():
        return _of_single_texts(plain, percent)
    return _of_several_texts(plain.withColumn("digest", digest), percent)


def _of_several_texts(plain: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` where ids have several texts: every text gets a number of its own, and the
    components that the texts of one document are in become one."""
    texts = plain.filter("doc_id is not null").select("doc_id", "digest").distinct()
    numbered = materialize(texts.withColumn("number", F.monotonically_increasing_id()), "numbered-texts")
    rows = plain.join(numbered, ["doc_id", "digest"], "left").select(F.col("number").alias("doc_id"), "text")
    found = materialize(_of_single_texts(rows, percent), "text-components")
    held = found.withColumnRenamed("doc_id", "number").drop("kept").join(numbered.drop("digest"), "number", "left")
    least = held.filter("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("a"))
    links = held.join(least, "doc_id").select("a", F.col("component_id").alias("b")).filter("a <> b").distinct()
    joined = connected_components(links).select(F.col("id").alias("component_id"), F.col("component").alias("joined"))
    held = held.join(joined, "component_id", "left").withColumn("joined", F.coalesce("joined", "component_id"))
    names = held.groupBy("joined").agg(F.min("doc_id").alias("name"))
    return held.join(names, "joined", "left").select(
        "doc_id", "n_shingles", F.col("name").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("name"), F.lit(True)).alias("kept"),
    )


def _of_single_texts(plain: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` of rows (doc_id, text) where equal ids have equal texts."""
    bands, rows = banding(percent)
    sketched = materialize(
        plain.mapInArrow(
            lambda batches: _sketch(batches, bands, rows),
            "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, bits array<bigint>",
        ),
        "sketches",
    )
    linkable = sketched.filter("set_key is not null and doc_id is not null")
    classes = materialize(
        linkable.groupBy("set_key").agg(F.min("doc_id").alias("doc_id")), "classes"
    )
    members = linkable.join(classes, ["set_key", "doc_id"], "left_semi").dropDuplicates(["doc_id", "set_key"])
    places = materialize(bucket_places(members.dropDuplicates(["doc_id"])), "places")

    ends = materialize(places.select("doc_id").distinct(), "ends")
    involved = plain.join(broadcast_if_small(ends, ends.count(), 32), "doc_id", "left_semi")
    sets = materialize(
        involved.mapInArrow(_sets, "doc_id bigint, shingles array<bigint>").dropDuplicates(["doc_id"]), "sets"
    )
    first = materialize(verified(sorted_neighbours(places, percent), sets, percent), "first")
    mixed = materialize(mixed_buckets(places, connected_components(first)), "mixed")
    links = first.union(verified(pairs_of_small(mixed, percent), sets, percent))
    if not mixed.filter(F.col("members") > SMALL_BUCKET).isEmpty():
        links = links.union(links_of_large(mixed, sets, percent))
    labels = connected_components(links)

    component = F.coalesce("component", "class_id", "doc_id")
    named = classes.withColumnRenamed("doc_id", "class_id")
    out = sketched.withColumn("class_key", F.when(F.col("doc_id").isNotNull(), F.col("set_key"))).join(
        named.withColumnRenamed("set_key", "class_key"), "class_key", "left"
    )
    out = out.join(labels.withColumnRenamed("id", "class_id"), "class_id", "left")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
