"""

Every query reads whole test tables. Scores are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import fixtures, schemas, settings
from shelfwise.functions import columns
from shelfwise.operators.listed import ClassLists
from shelfwise.operators.topn import merge_lists, to_lists, to_ranked, top_scores
from shelfwise.plans import content, factors, itemcf, online, stats, tuning
from shelfwise.session import fresh_path
from shelfwise.sources import batches, streams, tables, text
from shelfwise.sources.keyed import KeyedTable
from shelfwise.streaming import lists as list_stream
from shelfwise.streaming import ratings as rating_stream

try:
    from shelfwise.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("shelfwise.llm", "corpus_pipeline"):
        raise
    llm_queries = None

DIGITS = 6

#: Ratings of before 1999 count as history where a stream follows. A table that grows by batches has a
#: third one from July 2000 on; users with a rating since July 2001 are the ones looked up by key.
STREAM_START, STREAM_SECOND, LOOKUP_SINCE = 915148800, 962409600, 993945600


def entry(spark: SparkSession) -> DataFrame:
    """Item-based recommendations at sf0.001."""
    return _itemcf_recs(spark, "/root/testdata/sf0.001")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    for name in names or ("score",):
        df = df.withColumn(name, F.round(name, DIGITS))
    return df


def _stored_ratings(spark, base):
    return tables.materialize(fixtures.ratings(spark, base), "ratings")


# Sources and sinks


def _load_products(spark, base):
    path = fresh_path(spark, "product-text")
    line = F.concat_ws(
        "^", "productId", "name", F.lit("x"), F.lit("y"), "imageUrl", "categories", "tags"
    )
    fixtures.products(spark, base).select(line.alias("value")).write.text(path)
    return text.read_products(spark, path)


def _load_ratings(spark, base):
    path = fresh_path(spark, "rating-text")
    fixtures.ratings(spark, base).select(fixtures.rating_text(",").alias("value")).write.text(path)
    return text.read_ratings(spark, path)


def _scan_ratings(spark, base):
    return schemas.conform(fixtures.ratings(spark, base), schemas.RATING)


def _scan_products(spark, base):
    return schemas.conform(fixtures.products(spark, base), schemas.PRODUCT)


def _table_round_trip(spark, base):
    product_path, rating_path = tables.write_products_and_ratings(
        fixtures.products(spark, base), fixtures.ratings(spark, base), fresh_path(spark, "base")
    )
    ratings = tables.scan(spark, rating_path, schemas.RATING)
    return ratings.join(
        tables.scan(spark, product_path, schemas.PRODUCT).select("productId", "name"), "productId"
    )


def _upsert_user_recs(spark, base):
    ratings = fixtures.ratings(spark, base)
    path = fresh_path(spark, "upserts")
    old = ratings.groupBy("userId").agg(F.avg("score").alias("score"))
    new = (
        ratings.filter(F.col("timestamp") >= 978307200)
        .groupBy("userId")
        .agg(F.max("score").alias("score"))
    )
    batches.write_batch(old, path, 0)
    batches.write_batch(new, path, 1)
    return _rounded(batches.latest(batches.read_batches(spark, path, old.schema), "userId"))


def _keyed_snapshot(spark, base):
    """As ``upsert_user_recs``, replaced in place in hash buckets of the user."""
    ratings = fixtures.ratings(spark, base)
    kept = KeyedTable(spark, fresh_path(spark, "keyed"), T.StructType.fromDDL("userId int, score double"), "userId", 16)
    old = ratings.groupBy("userId").agg(F.avg("score").alias("score"))
    new = ratings.filter(F.col("timestamp") >= 978307200).groupBy("userId").agg(F.max("score").alias("score"))
    for batch, rows in enumerate((old, new)):
        kept.replace(tables.materialize(rows, "batch"), batch)
    return _rounded(kept.snapshot())


def _keyed_lookup(spark, base):
    """All ratings of the users who rated lately, from a table that grew by three batches."""
    ratings = _stored_ratings(spark, base)
    kept = KeyedTable(spark, fresh_path(spark, "keyed"), schemas.RATING, "userId", 16)
    time = F.col("timestamp")
    parts = (time < STREAM_START, (time >= STREAM_START) & (time < STREAM_SECOND), time >= STREAM_SECOND)
    for batch, part in enumerate(parts):
        kept.append(ratings.filter(part), batch)
    return kept.lookup(ratings.filter(time >= LOOKUP_SINCE))


def _ratings_with_counts_bucketed(spark, base):
    path = fresh_path(spark, "bucketed")
    name = f"ratings_by_product_{path.rsplit('-', 1)[1]}"
    table = tables.write_bucketed(fixtures.ratings(spark, base), name, path, "productId", 16)
    return itemcf.bucketed_ratings_with_counts(table)


def _dead_letters(spark, base):
    """Rating messages of which some are damaged, routed to two tables out of each micro-batch."""
    source = fresh_path(spark, "damaged")
    whole = fixtures.rating_text("|")
    kind = F.col("productId") % 50
    damaged = F.when(kind == 0, F.concat(F.lit("x"), whole)).when(kind == 1, F.concat_ws("|", "userId", "productId"))
    fixtures.ratings(spark, base).select(damaged.otherwise(whole).alias("value")).write.text(source)
    good, bad = fresh_path(spark, "good"), fresh_path(spark, "bad")
    (
        rating_stream.sorted_messages(streams.read_lines(spark, path=source))
        .writeStream.foreachBatch(rating_stream.route_messages(good, bad))
        .option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    rows = batches.read_batches(spark, good, schemas.RATING)
    dead = batches.read_batches(spark, bad, list_stream.DEAD)
    return rows.unionByName(dead, allowMissingColumns=True).drop("run", "batch")


def _messages_folder(spark, base):
    path = fresh_path(spark, "messages")
    fixtures.ratings(spark, base).select(fixtures.rating_text("|").alias("value")).write.text(path)
    return path


def _stream_ratings(spark, base):
    events = rating_stream.rating_events(
        streams.read_lines(spark, path=_messages_folder(spark, base))
    )
    out = fresh_path(spark, "streamed")
    (
        events.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return tables.scan(spark, out, schemas.RATING)


def _log_filter(spark, base):
    source, out = fresh_path(spark, "log"), fresh_path(spark, "rating-messages")
    fixtures.log_lines(spark, base).write.text(source)
    messages = rating_stream.rating_messages(streams.read_lines(spark, path=source))
    checkpoint = fresh_path(spark, "checkpoint")
    streams.write_lines(
        messages, checkpoint, available_now=True, path=out
    ).start().awaitTermination()
    return spark.read.text(out)


# Statistics and small operators


def _parse_events(spark, base):
    return rating_stream.rating_events(spark.read.text(_messages_folder(spark, base)))


def _distinct_ids(spark, base):
    ratings = fixtures.ratings(spark, base)
    users = stats.distinct_users(ratings).select(F.lit("user").alias("kind"), F.col("userId").alias("id"))
    products = stats.distinct_products(ratings)
    return users.unionByName(products.select(F.lit("product").alias("kind"), F.col("productId").alias("id")))


def _user_means(spark, base):
    return (
        fixtures.ratings(spark, base)
        .groupBy("userId", F.col("productId").alias("recProductId"))
        .agg(F.avg("score").alias("score"))
    )


def _top_n_per_key(spark, base):
    return _rounded(top_scores(_user_means(spark, base), "userId", 20))


def _merge_recs(spark, base):
    old = top_scores(_user_means(spark, base), "userId", 20)
    new = online.recent_ratings(fixtures.ratings(spark, base)).select(
        "userId", F.col("productId").alias("recProductId"), "score"
    )
    return _rounded(merge_lists(old, new, 20))


def _best_trial(spark, base):
    joined = tuning.observed_vs_predicted(
        fixtures.ratings(spark, base), fixtures.predictions(spark, base)
    )
    trials = joined.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("trial"))
    error = F.pow(F.col("score") - (F.col("prediction") + 0.1 * F.col("trial")), F.lit(2))
    rmse = F.sqrt(F.sum(F.col("pairs") * error) / F.sum("pairs"))
    return _rounded(tuning.best_trial(trials.groupBy("trial").agg(rmse.alias("rmse"))), "rmse")


# Item-based filtering


def _itemcf_similarity(spark, base):
    pairs = itemcf.similarity(itemcf.cooccurrence(fixtures.ratings(spark, base)))
    return _rounded(pairs.select("product1", "product2", "score"))


def _itemcf_recs(spark, base):
    ratings = _stored_ratings(spark, base)
    return _rounded(itemcf.with_empty_lists(ratings, itemcf.packed_item_recs(ratings)))


# Content similarity


def _tag_tokens(spark, base):
    words = content.tag_documents(fixtures.products(spark, base))
    return words.select(F.col("id").alias("productId"), F.posexplode("words").alias("pos", "term"))


def _hashing_tf(spark, base):
    features = content.hashed_features(fixtures.products(spark, base))
    return content.vector_entries(features, "counts").withColumnRenamed("value", "tf")


def _content_sims(spark, base):
    return content.content_sims(fixtures.products(spark, base))


def _ranked_sims(spark, base):
    return content.content_lists(fixtures.products(spark, base))


def _lists(ranked):
    return ranked.product_lists() if isinstance(ranked, ClassLists) else to_lists(ranked)


def _nested_recs(spark, base):
    return _rounded(to_ranked(_lists(_ranked_sims(spark, base))))


def _sim_matrix_pairs(spark, base):
    """Pairs of stored nested lists, which products with the same tags share."""
    path, ranked = fresh_path(spark, "lists"), _ranked_sims(spark, base)
    shared = isinstance(ranked, ClassLists)
    tables.write(ranked.class_lists() if shared else to_lists(ranked), path)
    stored = spark.read.parquet(path)
    return _rounded(tables.list_pairs(ranked.product_lists(stored) if shared else stored))


def _sim_matrix_map(spark, base):
    lists = _lists(_ranked_sims(spark, base))
    maps = lists.select("productId", columns.recs_map(F.col("recs")).alias("sims"))
    return _rounded(maps.select("productId", F.explode("sims").alias("recProductId", "score")))


# Factors


def _als_predict(spark, base):
    ratings = _stored_ratings(spark, base)
    model = factors.fit(ratings)
    return factors.predict(model, ratings.select("userId", "productId", "score"))


def _als_user_recs(spark, base):
    recs = factors.user_recs(factors.fit(_stored_ratings(spark, base)))
    return to_ranked(recs, "userId")


def _inner_product_top(spark, base):
    """Vectors as users, and the same vectors at ten lengths as products."""
    users = fixtures.vectors(spark, base)
    length = (F.col("id") % 10 + 1) / 10
    products = users.select("id", F.transform("vector", lambda x: x.cast("double") * length).alias("vector"))
    return _rounded(to_ranked(factors.best_products(users, products), "userId"))


def _als_item_factors(spark, base):
    return factors.item_factors(factors.fit(_stored_ratings(spark, base)))


def _als_product_sims(spark, base):
    return factors.product_sims(factors.fit(_stored_ratings(spark, base)))


def _train_test_split(spark, base):
    train, test = tuning.split(fixtures.ratings(spark, base))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def _als_grid_search(spark, base):
    train, test = tuning.split(fixtures.ratings(spark, base))
    return tuning.grid_search(train, test)


# Online recommendations: the newest rating of each user is the event


def _online_inputs(spark, base):
    ratings = _stored_ratings(spark, base)
    ranked = _ranked_sims(spark, base)
    events = tables.materialize(online.newest_events(ratings), "events")
    return tables.materialize(online.known_events(events, ranked), "known-events"), ratings, ranked


def _pair_similarity(spark, base):
    events, history, ranked = _online_inputs(spark, base)
    recent = online.recent_ratings(history).select("userId", F.col("productId").alias("recProductId"))
    wanted = events.select("userId", "productId").join(recent, "userId")
    return _rounded(online.pair_similarity(wanted, ranked))


def _unrated_candidates(spark, base):
    return _rounded(online.candidates(*_online_inputs(spark, base), n=None))


def _online_candidates(spark, base):
    return _rounded(online.candidates(*_online_inputs(spark, base)))


def _online_scores(spark, base):
    events, history, ranked = _online_inputs(spark, base)
    chosen = tables.materialize(online.candidates(events, history, ranked), "candidates")
    return _rounded(online.scores(chosen, history, ranked))


def _flat_user_lists(lists):
    """User lists as rows; an empty list is one row of nulls."""
    flat = lists.select("userId", F.posexplode_outer("recs").alias("pos", "rec"))
    return _rounded(
        flat.select(
            "userId",
            (F.col("pos") + 1).alias("rank"),
            F.col("rec.productId").alias("recProductId"),
            F.col("rec.score").alias("score"),
        )
    )


def _online_recs(spark, base):
    ratings = _stored_ratings(spark, base)
    return _flat_user_lists(online.recommend(ratings, ratings, _ranked_sims(spark, base)))


def _online_recs_stream(spark, base):
    """Log lines to messages to events to stored lists; all ratings arrive as a stream."""
    history_path, lists_path = fresh_path(spark, "history"), fresh_path(spark, "lists")
    source = fresh_path(spark, "log")
    fixtures.log_lines(spark, base).write.text(source)
    messages = rating_stream.rating_messages(streams.read_lines(spark, path=source))
    rating_stream.start_lists(
        rating_stream.rating_events(messages),
        spark.createDataFrame([], schemas.RATING),
        _ranked_sims(spark, base),
        history_path,
        lists_path,
        fresh_path(spark, "checkpoint"),
        available_now=True,
    ).awaitTermination()
    stored = batches.read_batches(spark, lists_path, schemas.USER_LIST)
    return _flat_user_lists(batches.latest(stored, "userId"))


def _online_recs_state(spark, base):
    """Lists kept current from a stream over older history; the job is started again when all has arrived."""
    ratings = _stored_ratings(spark, base)
    time, ranked = F.col("timestamp"), _ranked_sims(spark, base)
    source, checkpoint = fresh_path(spark, "messages"), fresh_path(spark, "checkpoint")
    ratings.filter(time >= STREAM_START).select(fixtures.rating_text("|").alias("value")).write.text(source)
    kept = list_stream.OnlineTables(spark, fresh_path(spark, "online"), buckets=16)
    for _ in range(2):
        list_stream.start_lists(
            streams.read_lines(spark, path=source), ratings.filter(time < STREAM_START), ranked, kept, checkpoint,
            available_now=True,
        ).awaitTermination()
    return _flat_user_lists(kept.lists.snapshot())


def _on_ratings(plan: Callable[[DataFrame], DataFrame], *digits: str):
    def query(spark: SparkSession, base: str) -> DataFrame:
        result = plan(fixtures.ratings(spark, base))
        return _rounded(result, *digits) if digits else result

    return query


def _on_products(plan: Callable[[DataFrame], DataFrame], *digits: str):
    def query(spark: SparkSession, base: str) -> DataFrame:
        result = plan(fixtures.products(spark, base))
        return _rounded(result, *digits) if digits else result

    return query


def _on_predictions(plan: Callable[[DataFrame, DataFrame], DataFrame], *digits: str):
    def query(spark: SparkSession, base: str) -> DataFrame:
        return _rounded(
            plan(fixtures.ratings(spark, base), fixtures.predictions(spark, base)), *digits
        )

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | (llm_queries.queries() if llm_queries else {})


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "load_products": _load_products,
        "load_ratings": _load_ratings,
        "scan_ratings": _scan_ratings,
        "scan_products": _scan_products,
        "table_round_trip": _table_round_trip,
        "upsert_user_recs": _upsert_user_recs,
        "keyed_snapshot": _keyed_snapshot,
        "keyed_lookup": _keyed_lookup,
        "dead_letters": _dead_letters,
        "stream_ratings": _stream_ratings,
        "log_filter": _log_filter,
        "parse_events": _parse_events,
        "popular_products": _on_ratings(stats.popular_products),
        "popular_by_month": _on_ratings(stats.popular_by_month),
        "average_scores": _on_ratings(stats.average_scores, "avg"),
        "rating_months": _on_ratings(stats.rating_months),
        "distinct_ids": _distinct_ids,
        "recent_ratings": _on_ratings(online.recent_ratings),
        "top_n_per_key": _top_n_per_key,
        "merge_recs": _merge_recs,
        "ratings_with_counts": _on_ratings(itemcf.ratings_with_counts),
        "ratings_with_counts_bucketed": _ratings_with_counts_bucketed,
        "co_rated_pairs": _on_ratings(itemcf.ordered_pairs),
        "cooccurrence": _on_ratings(itemcf.cooccurrence),
        "itemcf_similarity": _itemcf_similarity,
        "itemcf_recs": _itemcf_recs,
        "product_tags": _on_products(content.product_tags),
        "tag_tokens": _tag_tokens,
        "hashing_tf": _hashing_tf,
        "idf_weights": _on_products(content.idf_weights, "idf"),
        "tfidf_weights": _on_products(content.tfidf_weights, "weight"),
        "content_sims": _on_products(content.content_sims, "score"),
        "content_sims_hashed": _on_products(content.content_sims_hashed, "score"),
        "sim_threshold": _on_products(lambda p: content.content_sims(p, threshold=0.6), "score"),
        "nested_recs": _nested_recs,
        "sim_matrix_pairs": _sim_matrix_pairs,
        "sim_matrix_map": _sim_matrix_map,
        "embedding_cosine_pairs": lambda spark, base: _rounded(
            factors.vector_sims(fixtures.vectors(spark, base))
        ),
        "als_predict": _als_predict,
        "als_user_recs": _als_user_recs,
        "inner_product_top": _inner_product_top,
        "als_item_factors": _als_item_factors,
        "als_product_sims": _als_product_sims,
        "train_test_split": _train_test_split,
        "als_grid_search": _als_grid_search,
        "observed_vs_predicted": _on_predictions(tuning.observed_vs_predicted, "prediction"),
        "rmse": _on_predictions(tuning.rmse, "rmse"),
        "best_trial": _best_trial,
        "pair_similarity": _pair_similarity,
        "unrated_candidates": _unrated_candidates,
        "online_candidates": _online_candidates,
        "online_scores": _online_scores,
        "online_recs": _online_recs,
        "online_recs_stream": _online_recs_stream,
        "online_recs_state": _online_recs_state,
    }


# SQL twins. Named parts that several queries share; each query lists what it needs.

_PARTS = {
    "ratings": fixtures.RATINGS_SQL,
    "products": fixtures.PRODUCTS_SQL,
    "log_lines": fixtures.LOG_LINES_SQL,
    "counts": 'SELECT "productId", count(*) AS "count" FROM ratings GROUP BY ALL',
    "cells": 'SELECT "userId", "productId", count(*) AS times FROM ratings GROUP BY ALL',
    "ordered": """
        SELECT a."productId" AS product1, b."productId" AS product2,
               CAST(sum(a.times * b.times) AS BIGINT) AS cocount
        FROM cells a JOIN cells b ON a."userId" = b."userId" GROUP BY ALL""",
    "cooc": """
        SELECT product1, product2, cocount, c1."count" AS count1, c2."count" AS count2
        FROM ordered JOIN counts c1 ON c1."productId" = product1
        JOIN counts c2 ON c2."productId" = product2""",
    "tokens": r"""
        SELECT "productId", unnest(string_split_regex(lower(replace(tags, '|', ' ')), '\s')) AS term,
               unnest(range(len(string_split_regex(lower(replace(tags, '|', ' ')), '\s')))) AS pos
        FROM products""",
    "tf": 'SELECT "productId", term, count(*) AS tf FROM tokens GROUP BY ALL',
    "idf": """
        SELECT term, count(*) AS documents,
               ln(((SELECT count(*) FROM products) + 1) / (count(*) + 1)) AS idf
        FROM tf GROUP BY term""",
    "tfidf": 'SELECT "productId", term, tf, tf * idf AS weight FROM tf JOIN idf USING (term)',
    "lengths": """
        SELECT "productId", sqrt(sum(weight * weight)) AS length FROM tfidf
        GROUP BY ALL HAVING sum(weight * weight) > 0""",
    "sims": """
        SELECT a."productId", b."productId" AS "recProductId",
               sum(a.weight * b.weight) / (any_value(la.length) * any_value(lb.length)) AS score
        FROM tfidf a JOIN tfidf b ON a.term = b.term AND a."productId" <> b."productId"
        JOIN lengths la ON la."productId" = a."productId"
        JOIN lengths lb ON lb."productId" = b."productId"
        GROUP BY a."productId", b."productId"
        HAVING sum(a.weight * b.weight) / (any_value(la.length) * any_value(lb.length)) > 0.4""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY "productId"
            ORDER BY floor(score * 1e9 + 0.5) DESC, "recProductId") AS rank FROM sims""",
    "recent": """
        SELECT *, CAST(row_number() OVER (PARTITION BY "userId"
            ORDER BY "timestamp" DESC, "productId", score DESC) AS INTEGER) AS rank
        FROM ratings QUALIFY rank <= 21""",
    "current": """
        SELECT "userId", "productId" FROM recent
        WHERE rank = 1 AND "productId" IN (SELECT "productId" FROM sims)""",
    "wanted": """
        SELECT e."userId", e."productId", r."productId" AS "recProductId"
        FROM current e JOIN recent r ON r."userId" = e."userId\"""",
    "dots": """
        SELECT w."productId", w."recProductId", sum(a.weight * b.weight) / (any_value(la.length) * any_value(lb.length)) AS score
        FROM (SELECT DISTINCT "productId", "recProductId" FROM wanted WHERE "productId" <> "recProductId") w
        JOIN tfidf a ON a."productId" = w."productId"
        JOIN tfidf b ON b."productId" = w."recProductId" AND b.term = a.term
        JOIN lengths la ON la."productId" = w."productId"
        JOIN lengths lb ON lb."productId" = w."recProductId"
        GROUP BY w."productId", w."recProductId\"""",
    "unrated": """
        SELECT e."userId", s."recProductId", s.score
        FROM current e JOIN sims s USING ("productId")
        WHERE NOT EXISTS (SELECT 1 FROM ratings r
            WHERE r."userId" = e."userId" AND r."productId" = s."recProductId")""",
    "chosen": """
        SELECT *, CAST(row_number() OVER (PARTITION BY "userId"
            ORDER BY floor(score * 1e9 + 0.5) DESC, "recProductId") AS INTEGER) AS rank
        FROM unrated QUALIFY rank <= 20""",
    "scored": """
        SELECT c."userId", c."recProductId", avg(s.score * r.score)
               + log10(greatest(count(*) FILTER (r.score > 3), 1))
               - log10(greatest(count(*) FILTER (r.score <= 3), 1)) AS score
        FROM chosen c JOIN recent r ON r."userId" = c."userId"
        JOIN sims s ON s."productId" = c."recProductId" AND s."recProductId" = r."productId"
        GROUP BY c."userId", c."recProductId\"""",
    "means": """
        SELECT "userId", "productId" AS "recProductId", avg(score) AS score FROM ratings GROUP BY ALL""",
    "predictions": """
        SELECT DISTINCT "userId", "productId", prediction FROM ratings
        JOIN (SELECT "productId", avg(score) AS prediction FROM ratings GROUP BY ALL)
        USING ("productId")""",
    "observed": """
        SELECT "userId", "productId", r.score, p.prediction
        FROM ratings r JOIN predictions p USING ("userId", "productId")""",
}

_CONTENT = ["products", "tokens", "tf", "idf", "tfidf", "lengths", "sims"]
_ONLINE = ["ratings", *_CONTENT, "recent", "current"]


def _sql(parts: list[str], body: str) -> str:
    named = ",\n".join(f"{name} AS MATERIALIZED ({_PARTS[name]})" for name in parts)
    return f"WITH {named}\n{body}"


def _top(source: str, key: str, n: int) -> str:
    return f"""SELECT *, CAST(row_number() OVER (PARTITION BY "{key}"
        ORDER BY floor(score * 1e9 + 0.5) DESC, "recProductId") AS INTEGER) AS rank
        FROM {source} QUALIFY rank <= {n}"""


def oracle_sql() -> dict[str, str]:
    return _own_sql() | (llm_queries.oracle_sql() if llm_queries else {})


def _own_sql() -> dict[str, str]:
    ratings = _sql(["ratings"], "SELECT * FROM ratings")
    products = _sql(["products"], "SELECT * FROM products")
    cooc = ["ratings", "counts", "cells", "ordered", "cooc"]
    sims = 'SELECT "productId", "recProductId", round(score, 6) AS score FROM sims'
    online_recs = _sql(
        [*_ONLINE, "unrated", "chosen", "scored"],
        f"""SELECT e."userId", t.rank, t."recProductId", round(t.score, 6) AS score
        FROM current e LEFT JOIN ({_top("scored", "userId", 20)}) t USING ("userId")""",
    )
    upserted = _sql(
        ["ratings"],
        """SELECT "userId", round(coalesce(max(score) FILTER ("timestamp" >= 978307200),
           avg(score)), 6) AS score FROM ratings GROUP BY "userId\"""",
    )
    with_counts = _sql(
        ["ratings", "counts"],
        """SELECT "userId", r."productId", score, "count"
           FROM ratings r JOIN counts c ON r."productId" = c."productId\"""",
    )
    return {
        "load_products": products,
        "load_ratings": ratings,
        "scan_ratings": ratings,
        "scan_products": products,
        "table_round_trip": _sql(
            ["ratings", "products"],
            'SELECT r.*, p.name FROM ratings r JOIN products p USING ("productId")',
        ),
        "upsert_user_recs": upserted,
        "keyed_snapshot": upserted,
        "keyed_lookup": _sql(
            ["ratings"],
            f"""SELECT * FROM ratings WHERE "userId" IN
               (SELECT "userId" FROM ratings WHERE "timestamp" >= {LOOKUP_SINCE})""",
        ),
        "dead_letters": _sql(
            ["ratings"],
            """SELECT CASE WHEN kind > 1 THEN "userId" END AS "userId", CASE WHEN kind > 1 THEN "productId" END AS "productId",
               CASE WHEN kind > 1 THEN score END AS score, CASE WHEN kind > 1 THEN "timestamp" END AS "timestamp",
               CASE kind WHEN 0 THEN concat_ws('|', 'x' || "userId", "productId", score, "timestamp")
                 WHEN 1 THEN concat_ws('|', "userId", "productId") END AS line,
               CASE kind WHEN 0 THEN 'userId is not a valid int' WHEN 1 THEN 'score is not a valid double' END AS reason
               FROM (SELECT *, "productId" % 50 AS kind FROM ratings)""",
        ),
        "stream_ratings": ratings,
        "log_filter": _sql(
            ["ratings", "log_lines"],
            """SELECT trim(split_part(value, 'PRODUCT_RATING_PREFIX:', 2)) AS value
               FROM log_lines WHERE contains(value, 'PRODUCT_RATING_PREFIX:')""",
        ),
        "parse_events": ratings,
        "popular_products": _sql(["ratings", "counts"], "SELECT * FROM counts"),
        "popular_by_month": _sql(
            ["ratings"],
            """SELECT "productId", count(*) AS "count",
               CAST(strftime(to_timestamp("timestamp") AT TIME ZONE 'UTC', '%Y%m') AS INTEGER) AS yearmonth
               FROM ratings GROUP BY ALL""",
        ),
        "average_scores": _sql(
            ["ratings"],
            'SELECT "productId", round(avg(score), 6) AS avg FROM ratings GROUP BY "productId"',
        ),
        "rating_months": _sql(
            ["ratings"],
            """SELECT "productId", score,
               CAST(strftime(to_timestamp("timestamp") AT TIME ZONE 'UTC', '%Y%m') AS INTEGER) AS yearmonth
               FROM ratings""",
        ),
        "distinct_ids": _sql(
            ["ratings"],
            """SELECT DISTINCT 'user' AS kind, "userId" AS id FROM ratings
               UNION ALL SELECT DISTINCT 'product' AS kind, "productId" AS id FROM ratings""",
        ),
        "recent_ratings": _sql(["ratings", "recent"], "SELECT * FROM recent"),
        "top_n_per_key": _sql(
            ["ratings", "means"],
            f"""SELECT "userId", "recProductId", round(score, 6) AS score, rank
            FROM ({_top("means", "userId", 20)})""",
        ),
        "merge_recs": _sql(
            ["ratings", "means", "recent"],
            f"""SELECT "userId", "recProductId", round(score, 6) AS score, rank FROM (
            {_top(f'''(SELECT "userId", "recProductId", max(score) AS score FROM (
                SELECT "userId", "recProductId", score FROM ({_top("means", "userId", 20)})
                UNION ALL SELECT "userId", "productId" AS "recProductId", score FROM recent)
                GROUP BY ALL)''', "userId", 20)})""",
        ),
        "ratings_with_counts": with_counts,
        "ratings_with_counts_bucketed": with_counts,
        "co_rated_pairs": _sql(cooc, "SELECT * FROM cooc"),
        "cooccurrence": _sql(cooc, "SELECT * FROM cooc WHERE product1 < product2"),
        "itemcf_similarity": _sql(
            cooc,
            """SELECT product1, product2,
               round(cocount / sqrt(CAST(count1 AS DOUBLE) * count2), 6) AS score
               FROM cooc WHERE product1 < product2""",
        ),
        "itemcf_recs": _sql(
            cooc,
            """SELECT c."productId", rank, "recProductId", round(score, 6) AS score
               FROM counts c LEFT JOIN (
                 SELECT product1 AS "productId", product2 AS "recProductId",
                   cocount / sqrt(CAST(count1 AS DOUBLE) * count2) AS score,
                   CAST(row_number() OVER (PARTITION BY product1 ORDER BY
                     CAST(cocount AS DOUBLE) * cocount / count2 DESC, product2) AS INTEGER) AS rank
                 FROM cooc WHERE product1 <> product2 QUALIFY rank <= 10) USING ("productId")""",
        ),
        "product_tags": _sql(
            ["products"], """SELECT "productId", name, replace(tags, '|', ' ') AS tags FROM products"""
        ),
        "tag_tokens": _sql(
            ["products", "tokens"],
            'SELECT "productId", CAST(pos AS INTEGER) AS pos, term FROM tokens',
        ),
        "idf_weights": _sql(
            ["products", "tokens", "tf", "idf"],
            "SELECT term, documents, round(idf, 6) AS idf FROM idf",
        ),
        "tfidf_weights": _sql(
            ["products", "tokens", "tf", "idf", "tfidf"],
            """SELECT "productId", term, CAST(tf AS INTEGER) AS tf, round(weight, 6) AS weight FROM tfidf""",
        ),
        "content_sims": _sql(_CONTENT, sims),
        "sim_threshold": _sql(_CONTENT, f"{sims} WHERE sims.score > 0.6"),
        "nested_recs": _sql(
            [*_CONTENT, "ranked"],
            'SELECT "productId", rank, "recProductId", round(score, 6) AS score FROM ranked',
        ),
        "sim_matrix_pairs": _sql(_CONTENT, sims),
        "sim_matrix_map": _sql(_CONTENT, sims),
        "embedding_cosine_pairs": """
            WITH v AS (SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
            SELECT a.id AS "productId", b.id AS "recProductId",
                   round(list_cosine_similarity(a.x, b.x), 6) AS score
            FROM v a JOIN v b ON a.id <> b.id WHERE list_cosine_similarity(a.x, b.x) > 0.4""",
        "observed_vs_predicted": _sql(
            ["ratings", "predictions", "observed"],
            """SELECT "userId", "productId", score, round(prediction, 6) AS prediction,
               count(*) AS pairs FROM observed GROUP BY "userId", "productId", score, observed.prediction""",
        ),
        "rmse": _sql(
            ["ratings", "predictions", "observed"],
            "SELECT round(sqrt(avg(pow(score - prediction, 2))), 6) AS rmse FROM observed",
        ),
        "best_trial": _sql(
            ["ratings", "predictions", "observed"],
            """SELECT CAST(trial AS INTEGER) AS trial,
               round(sqrt(avg(pow(score - (prediction + 0.1 * trial), 2))), 6) AS rmse
               FROM observed CROSS JOIN range(5) t(trial) GROUP BY trial ORDER BY rmse, trial LIMIT 1""",
        ),
        "pair_similarity": _sql(
            [*_ONLINE, "wanted", "dots"],
            """SELECT "userId", "productId", "recProductId", round(CASE WHEN score > 0.4 THEN score ELSE 0 END, 6) AS score
               FROM wanted LEFT JOIN dots USING ("productId", "recProductId")""",
        ),
        "unrated_candidates": _sql(
            [*_ONLINE, "unrated"],
            'SELECT "userId", "recProductId", round(score, 6) AS score FROM unrated',
        ),
        "online_candidates": _sql(
            [*_ONLINE, "unrated", "chosen"],
            'SELECT "userId", "recProductId", round(score, 6) AS score, rank FROM chosen',
        ),
        "online_scores": _sql(
            [*_ONLINE, "unrated", "chosen", "scored"],
            'SELECT "userId", "recProductId", round(score, 6) AS score FROM scored',
        ),
        "online_recs": online_recs,
        "online_recs_stream": online_recs,
        "online_recs_state": f"""{online_recs}
            WHERE e."userId" IN (SELECT "userId" FROM recent WHERE rank = 1 AND "timestamp" >= {STREAM_START})""",
        "train_test_split": _sql(
            ["ratings"],
            f"""SELECT *, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', "userId", "productId", score, "timestamp", {settings.SEED})), 1, 8)
               AS BIGINT) % 100 < {settings.TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS part FROM ratings""",
        ),
        "inner_product_top": """
            WITH v AS (SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
            p AS (SELECT id, list_transform(x, lambda e: e * ((id % 10 + 1) / 10)) AS x FROM v),
            scored AS (SELECT u.id AS "userId", p.id AS "recProductId", list_inner_product(u.x, p.x) AS score FROM v u, p),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY "userId"
                ORDER BY floor(score * 1e9 + 0.5) DESC, "recProductId") AS rank FROM scored WHERE score > 0)
            SELECT "userId", rank, "recProductId", round(score, 6) AS score FROM ranked WHERE rank <= 20""",
    }
