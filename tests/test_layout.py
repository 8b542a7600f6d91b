"""Bucketed tables: joins by the lookup column leave the large side where it is."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shelfwise import fixtures, schemas
from shelfwise.plans import itemcf, online
from shelfwise.session import fresh_path
from shelfwise.sources import tables

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ratings(spark):
    return schemas.conform(fixtures.ratings(spark, BASE), schemas.RATING)


@pytest.fixture
def bucket_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables.use_buckets(spark)
    yield
    tables.use_buckets(spark, wide=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges_above_scans_of(frame, table):
    """How often an exchange lies on the way from a scan of the table to the plan's top."""
    lines = frame._jdf.queryExecution().sparkPlan().toString().splitlines()
    executed = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(re.match(r"[ :+\-|]*", line)[0])
    found = 0
    for i, line in enumerate(executed):
        if "FileScan" in line and table in line:
            level = depth(line)
            for above in reversed(executed[:i]):
                if depth(above) < level:
                    level = depth(above)
                    found += "Exchange" in above
    assert any("FileScan" in line and table in line for line in lines + executed)
    return found


def stored(spark, frame, name, key, buckets=4):
    return tables.write_bucketed(frame, name, fresh_path(spark, name), key, buckets)


def test_ratings_meet_their_counts_without_exchange(spark, ratings, bucket_joins):
    table = stored(spark, ratings, "ratings_by_product", "productId")
    found = itemcf.bucketed_ratings_with_counts(table)
    assert exchanges_above_scans_of(found, "ratings_by_product") == 0
    expected = itemcf.ratings_with_counts(ratings)
    assert found.exceptAll(expected.select(*found.columns)).isEmpty() and found.count() == expected.count()


def test_pair_lookup_leaves_the_pairs_in_place(spark, bucket_joins):
    pairs = spark.createDataFrame([(a, b, (a + b) / 10) for a in range(20) for b in range(20) if a != b], schemas.PAIR)
    table = stored(spark, pairs, "pairs_by_product", "productId")
    wanted = spark.createDataFrame([(1, 2), (3, 3), (99, 1)], "productId int, recProductId int")
    # Keyed by the product alone, which the buckets know; the other column is compared inside.
    found = online.pair_similarity(wanted, table)
    assert exchanges_above_scans_of(found, "pairs_by_product") == 0
    assert sorted(tuple(row) for row in found.collect()) == [(1, 2, pytest.approx(0.3)), (3, 3, 0.0), (99, 1, 0.0)]


def test_anti_join_leaves_the_history_in_place(spark, ratings, bucket_joins):
    table = stored(spark, ratings, "ratings_by_user", "userId")
    wanted = ratings.select("userId", (F.col("productId") + 1).alias("productId"))
    found = wanted.join(table.select("userId", "productId"), ["userId", "productId"], "left_anti")
    assert exchanges_above_scans_of(found, "ratings_by_user") == 0
    expected = wanted.join(ratings, ["userId", "productId"], "left_anti")
    assert found.count() == expected.count() > 0


def test_two_bucketed_tables_meet_bucket_by_bucket(spark, ratings, bucket_joins):
    left = stored(spark, ratings, "left_ratings", "productId")
    right = stored(spark, ratings.groupBy("productId").agg(F.avg("score").alias("mean")), "product_means", "productId")
    joined = left.join(right, "productId")
    assert exchanges_above_scans_of(joined, "left_ratings") == exchanges_above_scans_of(joined, "product_means") == 0
    assert joined.count() == ratings.count()


def test_a_table_is_replaced(spark, ratings):
    first = stored(spark, ratings, "replaced", "productId")
    assert first.count() == ratings.count()
    assert stored(spark, ratings.limit(3), "replaced", "userId", 2).count() == 3
