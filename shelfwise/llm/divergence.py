"""How far the sources of a language use its words differently.

Arrow kernels count terms inside the scan's tasks: ASCII lower case, a split by pattern,
dictionary codes and hashed group-bys give partial counts per language, source and term, which
Spark merges. The merged counts are dealt to columnar shards of terms; a shard is a dense matrix of
terms by sources whose absolute column differences are partial divergences, added up by Spark.

Contracts: null text, language or source counts as ''; equal rows and null ids count row by row; ids and other
columns are not read; an empty table gives an empty one. A group without terms has all counts 0, and a
language without kept terms has divergences of 0 and no terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import broadcast_if_small, slices
from shelfwise.operators.skew import hashed_chunk, triangle
from shelfwise.operators.topn import top_n
from shelfwise.sources.tables import materialize

#: What parts terms: all of ASCII but letters.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A term is kept if so many documents of its language hold it.
LEAST_DOCUMENTS = 30
#: Added to every count; shares are in units of one to UNIT.
PRIOR, UNIT = 5, 1_000_000_000
TOP_TERMS = 50
#: Bytes of text that are counted at a time, and rows of partial counts held by a task.
SLICE_BYTES, HELD_ROWS = 16 << 20, 1_000_000
#: Cells of one dense shard, and sources in one of its blocks.
CELLS, SOURCES = 1 << 17, 1024

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
GROUP = ["lang", "source"]


def _merged(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by([*GROUP, "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.select([*GROUP, "term", "n_sum", "docs_sum"]).rename_columns([*GROUP, "term", "n", "docs"])


def _slice_counts(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each term of each group; a row with a null term per group."""
    lang, source = (pc.dictionary_encode(batch.column(name)) for name in GROUP)
    width = max(len(source.dictionary), 1)
    group = pc.add(pc.multiply(pc.cast(lang.indices, pa.int64()), width), pc.cast(source.indices, pa.int64()))
    lists = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=SEPARATORS)
    parts, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    words = pc.greater(pc.binary_length(parts), 0)
    terms = pc.dictionary_encode(pc.filter(parts, words))
    found = pa.table({"row": pc.filter(row, words), "term": terms.indices})
    found = found.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    found = pa.table({"group": group.take(found["row"]), "term": found["term"], "n": found["count_all"]})
    sums = found.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])

    def rows(groups: pa.Array, term: pa.Array, n: pa.Array, docs: pa.Array) -> pa.Table:
        place = pc.divide(groups, width)
        columns = {
            "lang": lang.dictionary.take(place),
            "source": source.dictionary.take(pc.subtract(groups, pc.multiply(place, width))),
            "term": term, "n": n, "docs": docs,
        }
        return pa.table(columns, pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]))

    counted = [sums[name].combine_chunks() for name in ("group", "term", "n_sum", "n_count")]
    groups = pc.unique(group)
    zeros = pa.array(np.zeros(len(groups), np.int64))
    return pa.concat_tables([
        rows(counted[0], terms.dictionary.take(counted[1]), *counted[2:]),
        rows(groups, pa.nulls(len(groups), pa.string()), zeros, zeros),
    ])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in slices(batches, "text", SLICE_BYTES):
        held.append(_slice_counts(batch))
        if len(held) > 1 and sum(table.num_rows for table in held) > HELD_ROWS:
            held = [_merged(held)]
            if held[0].num_rows > HELD_ROWS // 2:
                yield from held.pop().to_batches()
    if held:
        yield from _merged(held).to_batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term; per group
    a row with a null term besides."""
    plain = docs.select(*(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in (*GROUP, "text")))
    sums = plain.mapInArrow(_partial_counts, COUNTS).groupBy(*GROUP, "term")
    return sums.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column | str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * terms)), exact for all bigints."""
    count, total, terms = (F.col(c) if isinstance(c, str) else c for c in (count, total, terms))
    above = (count + PRIOR).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + PRIOR * terms).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", above, below)


def _divergences(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over a shard's terms of the differences between each two sources of two blocks.

    Terms that no source of the two blocks has are not among the cells: they only add the
    difference of the shares of a count of 0, ``none``.
    """
    _, _, low, high = (part.as_py() for part in key)
    source, item, value = [], [], []
    if groups.num_rows:
        names, chunk = groups["source"].to_pylist(), groups["chunk"].to_numpy()
        place = pc.index_in(cells["source"], value_set=groups["source"].combine_chunks()).to_numpy()
        term = pc.dictionary_encode(cells["term"].combine_chunks())
        matrix = np.repeat(groups["none"].to_numpy()[None, :], len(term.dictionary), axis=0)
        matrix[term.indices.to_numpy(zero_copy_only=False), place] = cells["p"].to_numpy()
        columns, none = np.ascontiguousarray(matrix.T), groups["none"].to_numpy()
        unseen = groups["shard_terms"][0].as_py() - len(term.dictionary)
        right = np.flatnonzero(chunk == high)
        for i in np.flatnonzero(chunk == low):
            others = right[right > i] if low == high else right
            sums = np.abs(columns[others] - columns[i]).sum(axis=1) + unseen * np.abs(none[others] - none[i])
            for j, total in zip(others.tolist(), sums.tolist()):
                source += [names[i], names[j]]
                item += [names[j], names[i]]
                value += [total, total]
    lang = pa.repeat(key[0], len(source)) if source else pa.array([], pa.string())
    return pa.table({"lang": lang, "source": pa.array(source, pa.string()), "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): per source of a language, its distance from each other
    source (part ``pair``) and the terms that it uses more than its language does (part ``term``)."""
    counts = materialize(term_counts(docs), "term-counts")
    seen = counts.filter("term is not null")
    kept = seen.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = materialize(kept.filter(F.col("docs") >= least_documents).drop("docs"), "kept-terms")
    used = materialize(seen.drop("docs").join(kept, ["lang", "term"]), "kept-counts")

    groups = counts.filter("term is null").select(*GROUP)
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    langs = langs.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total")), "lang", "left")
    totals = groups.join(used.groupBy(*GROUP).agg(F.sum("n").alias("total")), GROUP, "left").join(langs, "lang")
    zero = F.lit(0).cast("bigint")
    totals = materialize(totals.fillna(0, ["total", "terms", "lang_total"]).select(
        *GROUP, "total", "terms", "lang_total",
        F.greatest(F.lit(1), F.ceil(F.col("terms") * F.least("sources", F.lit(2 * SOURCES)) / CELLS)).alias("shards"),
        F.ceil(F.col("sources") / SOURCES).alias("chunks"),
        F.when(F.col("terms") > 0, share(zero, "total", "terms")).otherwise(zero).alias("none"),
    ), "group-totals")
    totals = totals.withColumn("chunk", hashed_chunk(F.col("chunks"), "source"))
    shares = used.join(broadcast_if_small(totals, totals.count(), 200), GROUP)
    shares = shares.select(
        *GROUP, "term", "n", "shards", "chunk", "chunks",
        share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"),
    )

    by = ["lang", "shard", "lo", "hi"]
    cells = shares.select(*GROUP, "term", "p", "chunk", "chunks", hashed_chunk(F.col("shards"), "term").alias("shard"))
    cells = triangle(cells, F.col("chunk"), F.col("chunks")).drop("chunk", "chunks")
    every = totals.select(*GROUP, "none", "chunk", "chunks", F.explode(F.sequence(zero, F.col("shards") - 1)).alias("shard"))
    sizes = kept.join(totals.select("lang", "shards").distinct(), "lang").groupBy("lang", hashed_chunk(F.col("shards"), "term").alias("shard"))
    every = every.join(sizes.agg(F.count(F.lit(1)).alias("shard_terms")), ["lang", "shard"], "left").fillna(0, ["shard_terms"])
    every = triangle(every, F.col("chunk"), F.col("chunks")).drop("chunks")
    partial = cells.groupBy(*by).cogroup(every.groupBy(*by)).applyInArrow(_divergences, "lang string, source string, item string, value bigint")
    pairs = partial.groupBy(*GROUP, "item").agg(F.sum("value").alias("value"))
    terms = shares.filter("n > 0 and p > q").select(*GROUP, F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    def ranked(rows: DataFrame, part: str, n: int) -> DataFrame:
        ranks = top_n(rows, GROUP, [F.col("value").desc(), F.col("item").asc()], n)
        return ranks.select(*GROUP, F.lit(part).alias("part"), "item", "value", "rank")

    return ranked(pairs, "pair", (1 << 31) - 1).unionByName(ranked(terms, "term", top_terms))


#: The audit in DuckDB.
SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), parts AS (
  SELECT doc, lang, source, unnest(string_split_regex(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM parts WHERE term <> '' GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 30
), per_lang AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), totals AS (
  SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (t.total + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (l.total + 5 * v) AS q
  FROM cells JOIN totals t USING (lang, source) JOIN per_lang l USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every_pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), rows AS (
  SELECT * FROM every_pair UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
  FROM rows
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
