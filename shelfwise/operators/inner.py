"""The items with the largest inner products for every user, exact, without scoring every pair.

Items are visited in blocks of falling norm. A user's score for any item of a block is at most the
user's norm times the block's largest norm; once that is below the user's n-th best score so far,
this block and all behind it are skipped for the user. Items travel in slabs of a bounded size,
one broadcast at a time, to the users that still need them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.tables import materialize

# Workers get the kernel with the plan, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ITEMS = 1024
BAND_USERS = 1024
#: Bytes of items in one broadcast.
SLAB_BYTES = 32 << 20

STATE = "id int, vector array<double>, products array<int>, scores array<double>, blocks int, done boolean"


def order_keys(scores: np.ndarray) -> np.ndarray:
    """Scores in units of the last compared digit, as whole numbers."""
    return np.floor(scores * 1e9 + 0.5)


def best_of(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` best columns of each row by falling key and rising id, in that order."""
    keys = order_keys(scores)
    rows, width = keys.shape
    if width > n:
        last = np.partition(keys, width - n, axis=1)[:, width - n, None]
        mask = keys >= last
        # Where more than n reach the last place, ties on it go to the smaller ids.
        for row in np.flatnonzero(mask.sum(axis=1) > n):
            at = np.flatnonzero(mask[row])
            mask[row, at[np.lexsort((ids[row, at], -keys[row, at]))[n:]]] = False
        at = np.nonzero(mask)[1].reshape(rows, n)
        scores, ids, keys = (np.take_along_axis(part, at, axis=1) for part in (scores, ids, keys))
    order = np.lexsort((ids, -keys), axis=-1)
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


class Band:
    """Some users with their best items so far."""

    def __init__(self, vectors: np.ndarray, scores: np.ndarray, ids: np.ndarray):
        self.vectors, self.scores, self.ids = vectors, scores, ids
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.blocks = np.zeros(len(vectors), np.int64)

    def in_reach(self, norm: float) -> np.ndarray:
        """Users who could have an item of that norm among their best. Only positive scores count;
        the margin covers rounding of the products."""
        bound = self.norms * norm * (1 + 1e-12)
        return (bound > 0) & (order_keys(bound) >= order_keys(self.scores[:, -1]))

    def visit(self, ids: np.ndarray, vectors: np.ndarray, norm: float) -> bool:
        """Score a block of items for the users in its reach; False if there is none."""
        users = np.flatnonzero(self.in_reach(norm))
        if not len(users):
            return False
        found = self.vectors[users] @ vectors.T
        found[~(found > 0)] = -np.inf
        scores = np.hstack([self.scores[users], found])
        among = np.hstack([self.ids[users], np.broadcast_to(ids, found.shape)])
        self.scores[users], self.ids[users] = best_of(scores, among, self.ids.shape[1])
        self.blocks[users] += 1
        return True


def _visit_slab(slab: Broadcast, n: int, beyond: float, block_items: int) -> Callable:
    """Take a slab's items into the users' state. ``beyond`` is the largest norm behind the slab."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, items, norms = slab.value
        for whole in batches:
            for start in range(0, whole.num_rows, BAND_USERS):
                batch = whole.slice(start, BAND_USERS)
                rows = batch.num_rows
                vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
                scores, ids = np.full((rows, n), -np.inf), np.zeros((rows, n), np.int32)
                held = batch.column("products").value_lengths().to_numpy()
                filled = np.arange(n) < held[:, None]
                scores[filled] = batch.column("scores").flatten().to_numpy()
                ids[filled] = batch.column("products").flatten().to_numpy()
                band = Band(vectors, scores, ids)
                for at in range(0, len(item_ids), block_items):
                    part = slice(at, at + block_items)
                    if not band.visit(item_ids[part], items[part], norms[at]):
                        break
                filled = band.scores > 0
                offsets = pa.array(np.concatenate([[0], np.cumsum(filled.sum(axis=1))]).astype(np.int32))
                yield pa.record_batch({
                    "id": batch.column("id"), "vector": batch.column("vector"),
                    "products": pa.ListArray.from_arrays(offsets, pa.array(band.ids[filled], pa.int32())),
                    "scores": pa.ListArray.from_arrays(offsets, pa.array(band.scores[filled])),
                    "blocks": pa.array((batch.column("blocks").to_numpy() + band.blocks).astype(np.int32)),
                    "done": pa.array(~band.in_reach(beyond)),
                })

    return run


def _slabs(items: DataFrame, slab_rows: int) -> tuple[list[tuple[float, float, int, int]], dict[float, float]]:
    """Slabs of falling norm as (least norm, norm below which it ends, part, parts): cut by quantiles of the
    norm, and where many items share a norm, by hash. Besides, each cut's largest norm."""
    total = items.count()
    cuts = -(-total // slab_rows)
    bounds = [0.0, np.inf]
    if cuts > 1:
        bounds = sorted({*bounds, *items.approxQuantile("norm", [i / cuts for i in range(1, cuts)], 0.25 / cuts)})
    lower = F.lit(0.0)
    for bound in bounds[1:-1]:
        lower = F.when(F.col("norm") >= bound, F.lit(float(bound))).otherwise(lower)
    # One row a cut.
    found = items.groupBy(lower.alias("lower")).agg(F.count(F.lit(1)).alias("size"), F.max("norm").alias("norm")).collect()
    sizes, largest = ({row["lower"]: row[name] for row in found} for name in ("size", "norm"))
    slabs = []
    for low, high in reversed([*zip(bounds, bounds[1:])]):
        parts = -(-sizes.get(low, 0) // slab_rows)
        slabs += [(low, high, part, parts) for part in range(parts)]
    return slabs, largest


def best_items(
    users: DataFrame, items: DataFrame, n: int, slab_bytes: int = SLAB_BYTES, block_items: int = BLOCK_ITEMS,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """(id, products, scores, blocks) per user (id, vector): up to ``n`` items (id, vector) with the largest positive
    inner products, equal ones by smaller id, and how many blocks of items were scored for the user.

    Vectors have one length and no nulls. Users without a positive product have empty lists. ``counts`` gets
    the number of ``blocks`` and ``slabs`` of items and of ``rounds`` that had users to serve.
    """
    spark = users.sparkSession
    vector = F.col("vector").cast("array<double>")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    items = materialize(items.select("id", vector.alias("vector")).withColumn("norm", norm), "items")
    dimension = items.agg(F.max(F.size("vector"))).first()[0] or 0
    slab_rows = max(1, slab_bytes // (8 * dimension + 16))
    slabs, largest = _slabs(items, slab_rows)
    empty = [F.array().cast(f"array<{kind}>").alias(name) for name, kind in (("products", "int"), ("scores", "double"))]
    state = users.select("id", vector.alias("vector"), *empty, F.lit(0).alias("blocks"), F.lit(False).alias("done"))
    finished, blocks, rounds = [], 0, 0
    for number, (low, high, part, parts) in enumerate(slabs):
        rows = items.filter((F.col("norm") >= low) & (F.col("norm") < high) & (F.pmod(F.xxhash64("id"), F.lit(parts)) == part))
        # At most a slab: the number of items was counted.
        table = rows.orderBy(F.col("norm").desc(), "id").toArrow().combine_chunks()
        blocks += -(-table.num_rows // block_items)
        norms = table["norm"].to_numpy()
        matrix = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        slab = spark.sparkContext.broadcast((table["id"].to_numpy(), matrix, norms))
        last = number + 1 == len(slabs)
        # Other parts of the same cut reach up to its largest norm.
        beyond = 0.0 if last else largest[low] if part + 1 < parts else low
        state = state.mapInArrow(_visit_slab(slab, n, beyond, block_items), STATE)
        rounds += 1
        if not last:
            state = materialize(state, "best-items")
            finished.append(state.filter("done"))
            state = state.filter("not done")
            if state.isEmpty():
                break
    if counts is not None:
        counts.update(blocks=blocks, slabs=len(slabs), rounds=rounds)
    for more in finished:
        state = state.unionByName(more)
    return state.select("id", "products", "scores", "blocks")
