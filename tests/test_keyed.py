"""Keyed tables: replaced and appended batches, replays, lost writers, flat cost."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise.session import fresh_path
from shelfwise.sources import keyed
from shelfwise.sources.keyed import FAN, KEEP, KeyedTable, LostRace, fold_parts

SCHEMA = "userId int, value int"


def table(spark, buckets=4, path=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    return KeyedTable(spark, path or fresh_path(spark, "test-keyed"), schema, "userId", buckets)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def files(kept):
    return [path for path in Path(kept.path).rglob("*.parquet")]


def test_replace_keeps_one_row_per_key(spark):
    kept, expected, rng = table(spark), {}, random.Random(1)
    assert rows(kept.snapshot()) == []
    for batch in range(12):
        new = {rng.randrange(30): batch for _ in range(rng.randint(0, 6))}
        assert kept.replace(frame(spark, list(new.items())), batch)
        expected |= new
        assert rows(kept.snapshot()) == sorted(expected.items())
    wanted = frame(spark, [(k, 0) for k in (3, 4, 99)])
    assert rows(kept.lookup(wanted)) == rows(kept.lookup(wanted, few=True)) == sorted((k, expected[k]) for k in (3, 4) if k in expected)


def test_append_keeps_all_rows_in_few_parts(spark):
    kept, expected = table(spark, buckets=2), []
    for batch in range(FAN * 3):
        new = [(batch % 5, batch), (batch % 5, batch), (7, batch)]
        assert kept.append(frame(spark, new), batch)
        expected += new
    assert rows(kept.snapshot()) == sorted(expected)
    parts = kept.manifest()["parts"]
    assert all(len([p for p, at in own if at == level]) < FAN for own in parts.values() for level in range(4))
    assert max(len(own) for own in parts.values()) < FAN * 2
    assert rows(kept.lookup(frame(spark, [(7, 0)]))) == sorted(r for r in expected if r[0] == 7)


def test_replayed_batch_is_not_applied_again(spark):
    kept = table(spark)
    kept.append(frame(spark, [(1, 1), (2, 2)]), 0)
    before = kept.manifest()
    assert not kept.append(frame(spark, [(1, 1), (2, 2)]), 0)
    assert kept.manifest() == before and kept.snapshot().count() == 2
    assert kept.next_run() == 2 and kept.append(frame(spark, [(1, 3)]), 0, run=2)
    assert kept.snapshot().count() == 3
    assert kept.append(frame(spark, []), 1, run=2) and kept.manifest()["applied"] == {"1": 0, "2": 1}


def test_lost_writer_leaves_nothing_visible(spark, monkeypatch):
    kept = table(spark)
    kept.replace(frame(spark, [(1, 1), (2, 2)]), 0)

    def lost(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_swap", lost)
        for _ in range(2):
            with pytest.raises(OSError):
                kept.replace(frame(spark, [(1, 9)]), 1)
    assert rows(kept.snapshot()) == [(1, 1), (2, 2)]
    assert kept.sweep() == 0, "a writer may still be at work on the next version"
    assert kept.replace(frame(spark, [(1, 5)]), 1)
    assert rows(kept.snapshot()) == [(1, 5), (2, 2)]
    assert kept.sweep() == 2
    assert rows(kept.snapshot()) == [(1, 5), (2, 2)]


def test_second_of_two_writers_fails(spark, monkeypatch):
    kept = table(spark)
    kept.replace(frame(spark, [(1, 1)]), 0)
    stale = kept.manifest()
    kept.replace(frame(spark, [(1, 2)]), 1)
    monkeypatch.setattr(kept, "manifest", lambda: stale)
    with pytest.raises(LostRace):
        kept.replace(frame(spark, [(1, 3)]), 1)
    assert rows(table(spark, path=kept.path).snapshot()) == [(1, 2)]


def test_reader_of_an_older_version_keeps_its_files(spark):
    kept = table(spark)
    kept.replace(frame(spark, [(1, 0)]), 0)
    older = kept.snapshot()
    for batch in range(1, KEEP):
        kept.replace(frame(spark, [(1, batch)]), batch)
    assert rows(older) == [(1, 0)]
    kept.replace(frame(spark, [(1, 99)]), 99)
    assert len(kept.versions()) == KEEP and len(files(kept)) == KEEP


def test_other_number_of_buckets(spark):
    kept, expected = table(spark, buckets=2), [(i, i) for i in range(50)]
    kept.append(frame(spark, expected), 0)
    kept.rebucket(7)
    assert kept.manifest()["buckets"] == 7 and rows(kept.snapshot()) == expected
    assert table(spark, buckets=3, path=kept.path).manifest()["buckets"] == 7
    assert not kept.append(frame(spark, expected), 0) and kept.append(frame(spark, [(1, 1)]), 1)
    assert rows(kept.lookup(frame(spark, [(1, 0)]))) == [(1, 1), (1, 1)]


def test_lookup_reads_the_buckets_of_its_keys_only(spark):
    kept = table(spark, buckets=16)
    kept.append(frame(spark, [(i, i) for i in range(500)]), 0)
    found = kept.lookup(frame(spark, [(5, 0)]))
    assert rows(found) == [(5, 5)]
    read = kept.lookup(frame(spark, [(5, 0)])).inputFiles()
    assert len({path.split("bucket=")[1].split("/")[0] for path in read}) == 1


def test_a_batch_writes_its_own_buckets_only(spark):
    kept = table(spark, buckets=16)
    kept.replace(frame(spark, [(i, i) for i in range(500)]), 0)
    before = kept.manifest()["parts"]
    kept.replace(frame(spark, [(5, 6)]), 1)
    after = kept.manifest()["parts"]
    assert sum(before[b] != after[b] for b in before) == 1


def test_thousand_batches_at_flat_cost(spark, monkeypatch):
    """Writes of data are left out; manifests are real. What a batch lists, loads, names and folds stays bounded."""
    kept, work, loads = table(spark, buckets=3), [], []
    folded, load = [], kept._load
    monkeypatch.setattr(kept, "_touched", lambda *_: [0, 1, 2])
    monkeypatch.setattr(kept, "_read", lambda parts: folded.append(len(parts)) or frame_of_none)
    monkeypatch.setattr(kept, "_write", lambda rows, manifest: f"{manifest['version'] + 1:012d}-x")
    monkeypatch.setattr(kept, "_load", lambda version: loads.append(version) or load(version))
    frame_of_none = frame(spark, [])
    for batch in range(1000):
        folded.clear(), loads.clear()
        kept.append(frame_of_none, batch)
        manifest = load(kept.versions()[-1])
        work.append((sum(map(len, manifest["parts"].values())), len(loads), sum(folded)))
    levels = 4  # 8 ** 4 > 1000
    assert max(parts for parts, _, _ in work) <= 3 * levels * (FAN - 1)
    assert max(n for _, n, _ in work) <= 3
    assert len(kept.versions()) == KEEP
    # A part is folded once a level, so the mean over many batches stays put.
    first, last = (sum(n for *_, n in work[a:b]) / (b - a) for a, b in ((0, 512), (488, 1000)))
    assert last <= first * 1.2


def test_parts_fold_like_digits_count_up():
    parts = []
    for i in range(FAN**2):
        parts, folded, level = fold_parts(parts)
        parts = [*parts, [str(i), level]]
        assert len(folded) in (0, FAN - 1, 2 * (FAN - 1))
    assert [level for _, level in parts] == [2]
    assert keyed.fold_parts([])[1:] == ([], 0)


def test_a_hot_key_is_split_over_files(spark):
    kept = table(spark, buckets=2)
    hot = spark.range(200_000).select(F.lit(1).alias("userId"), F.col("id").cast("int").alias("value"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        kept.append(hot.repartition(8), 0)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(files(kept)) > 1 and kept.lookup(frame(spark, [(1, 0)])).count() == 200_000
