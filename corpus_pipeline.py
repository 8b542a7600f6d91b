"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontamination, minhash, packing, secrets, toxicity
from shelfwise.llm.common import broadcast_if_small, held_out, read, vocabulary
from shelfwise.sources.tables import materialize

ORACLE_SQL = None

#: Least Jaccard similarity, in percent, at which two documents of the pipeline count as near copies.
NEAR_PERCENT = 80


def _without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The rows whose doc_id is not among ``ids``; rows without an id stay."""
    ids = materialize(ids.select("doc_id").distinct(), name)
    return docs.join(broadcast_if_small(ids, ids.count(), 32), "doc_id", "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"), ~held_out("doc_id", 3, 1))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, and one row of each id."""
    verdicts = materialize(minhash.near_duplicates(docs, percent=NEAR_PERCENT), "verdicts").filter("doc_id is not null")
    kept = _without(docs, verdicts.filter("not kept"), "copies")
    if not verdicts.groupBy("doc_id").count().filter("count > 1").isEmpty():
        named = kept.filter("doc_id is not null").dropDuplicates(["doc_id"])
        kept = named.unionByName(kept.filter("doc_id is null"))
    return kept


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(docs, read(spark, sf_dir, "benchmark"))
    return _without(docs, found, "contaminated")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay; a mark stands for each of their secrets."""
    length = F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))
    return secrets.redact(docs).withColumn("n_chars", length)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{number + 1}")
    return docs
