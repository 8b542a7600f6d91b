"""Quality rules: fixed ones, and multivariate outliers among documents of a language and source.

Transformed statistics of a document form a vector. For each language and source a minimum
covariance determinant estimate says what is usual: concentration steps keep the half of the
rows that is nearest to the current centre, and fit centre and covariance anew. A document
whose Mahalanobis distance is too large is rejected. Functions of Spark SQL only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.tables import materialize

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
STEPS = 6
#: Share of a group's rows that the estimate is made of.
SHARE = 0.75
#: Groups of fewer rows take their language's estimate, and small languages that of all rows.
LEAST_ROWS = 200
#: Squared distance above which a document is an outlier. The floors below widen the usual region, so
#: this is further out than the same number would be for a chi-squared variable of five dimensions.
LIMIT = 9.5
#: Smallest standard deviation of each statistic, so that one that hardly varies does not decide alone.
FLOORS = {"word_length": 0.08, "symbols": 0.10, "dup_lines": 0.20, "repeats": 0.20, "capitals": 0.08}
STATISTICS = list(FLOORS)
#: Words that count as seen before a text begins, so that short texts lie near what is usual.
PRIOR_WORDS, PRIOR_LENGTH = 20, 5.5


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each text; ``docs`` has these three and ``text``."""
    bare = F.translate("text", " \t\n\x0b\x0c\r", "")
    cut = docs.select(
        "doc_id", "lang", "source",
        F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"),
        F.length(bare).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("bigint").alias("capitals"),
        F.filter(F.split("text", "\n"), lambda line: F.translate(line, " \t\x0b\x0c\r", "") != "").alias("lines"),
    )
    hashed = cut.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols", "capitals",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            F.size("words") > WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
        ).alias("windows"),
    )
    # Windows by hash and place; those with an equal neighbour in that order occur twice or more.
    repeated = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = hashed.withColumn(
        "windows",
        F.when(repeated, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    starts = F.sort_array(
        F.transform(
            F.filter(
                F.transform(
                    "windows",
                    lambda x, k: F.struct(
                        x["i"].alias("i"),
                        (
                            F.coalesce(F.get("windows", k - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get("windows", k + 1)["h"] == x["h"], F.lit(False))
                        ).alias("twice"),
                    ),
                ),
                lambda x: x["twice"],
            ),
            lambda x: x["i"],
        )
    )
    found = placed.withColumn("windows", F.when(F.col("windows").isNotNull(), starts))
    covered = F.aggregate(
        F.transform("windows", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("windows", k + 1) - i, F.lit(WINDOW)))),
        F.lit(0), lambda total, n: total + n,
    )
    return found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("windows")


def _share(count: Column, total: Column) -> Column:
    """The arcsine of the root of a share, which makes its variance even."""
    return F.asin(F.sqrt(F.least(F.lit(1.0), count / F.greatest(total, F.lit(1)))))


def vectors(counts: DataFrame) -> DataFrame:
    words = F.col("n_words") + PRIOR_WORDS
    return counts.withColumns({
        "word_length": F.log((F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH) / words),
        "symbols": _share(F.col("n_symbols"), F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH),
        "dup_lines": _share(F.col("n_dup_lines"), F.col("n_lines") + 4),
        "repeats": _share(F.col("n_repeat_words"), words),
        "capitals_share": _share(F.col("capitals"), F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH),
    }).drop("capitals").withColumnRenamed("capitals_share", "capitals")


def _factor(estimate: DataFrame) -> DataFrame:
    """The estimate (m<i>, c<i><j>) with the Cholesky factor l<i><j> of its covariance."""
    for j in range(len(STATISTICS)):
        for i in range(j, len(STATISTICS)):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            entry = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
            estimate = estimate.withColumn(f"l{i}{j}", entry)
    return estimate


def distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with ``d2``, the squared distance from its group's estimate. Both have ``grp``."""
    size = range(len(STATISTICS))
    met = rows.join(estimate, "grp")
    keep = [c for c in rows.columns]
    for i in size:
        rest = F.col(STATISTICS[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        met = met.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in size[1:]), F.col("z0") * F.col("z0"))
    return met.select(*keep, total.alias("d2"))


def _estimate(rows: DataFrame) -> DataFrame:
    """Mean and covariance of each group; variances are not below their floors."""
    size = range(len(STATISTICS))
    means = [F.avg(name).alias(f"m{i}") for i, name in enumerate(STATISTICS)]
    products = [
        F.covar_pop(STATISTICS[i], STATISTICS[j]).alias(f"c{i}{j}") for i in size for j in size if i >= j
    ]
    fitted = rows.groupBy("grp").agg(*means, *products)
    floors = {f"c{i}{i}": F.col(f"c{i}{i}") + FLOORS[name] ** 2 for i, name in enumerate(STATISTICS)}
    return _factor(fitted.withColumns(floors))


def _start(rows: DataFrame) -> DataFrame:
    """Medians, and squared scaled median deviations as a diagonal covariance."""
    size = range(len(STATISTICS))
    medians = rows.groupBy("grp").agg(
        *[F.percentile_approx(name, 0.5, 1000).alias(f"m{i}") for i, name in enumerate(STATISTICS)]
    )
    away = rows.join(medians, "grp").groupBy("grp").agg(
        *[F.percentile_approx(F.abs(F.col(name) - F.col(f"m{i}")), 0.5, 1000).alias(f"a{i}") for i, name in enumerate(STATISTICS)]
    )
    both = medians.join(away, "grp")
    for i in size:
        for j in range(i + 1):
            value = F.pow(1.4826 * F.col(f"a{i}"), F.lit(2)) + FLOORS[STATISTICS[i]] ** 2 if i == j else F.lit(0.0)
            both = both.withColumn(f"c{i}{j}", value)
    return _factor(both.drop(*[f"a{i}" for i in size]))


def minimum_covariance(rows: DataFrame) -> DataFrame:
    """Centre, covariance and factor of each group by concentration steps from the median start.
    ``rows`` has ``grp`` and the statistics; what a step gathers is one row per group."""
    estimate = materialize(_start(rows), "mcd")
    for _ in range(STEPS):
        near = distances(rows, estimate)
        cut = near.groupBy("grp").agg(F.percentile_approx("d2", SHARE, 1000).alias("cut"))
        estimate = materialize(_estimate(near.join(cut, "grp").filter("d2 <= cut")), "mcd")
    return estimate


def judge(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    limit: float = LIMIT,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, d2, kept for every row.

    A null text is empty, a null language or source is a group of its own, repeated rows give
    repeated results and null ids stay null; further columns are not read. Rows that fail a
    fixed rule do not enter the estimates and have no distance.
    """
    plain = docs.select(
        F.col(id_column).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    counts = vectors(measured(plain)).withColumn(
        "base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    )
    # Each row in the groups it may be judged by, finest first; only groups with enough rows remain.
    levels = F.array(F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"}), F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}), F.lit("{}"))
    counts = materialize(counts.withColumn("levels", levels), "quality")
    passed = counts.filter("not base_failed")
    sizes = passed.select(F.explode("levels").alias("grp")).groupBy("grp").count()
    large = materialize(sizes.filter((F.col("count") >= LEAST_ROWS) | (F.col("grp") == "{}")).select("grp"), "groups")
    grouped = passed.select(F.explode("levels").alias("grp"), *STATISTICS).join(large, "grp")
    estimate = minimum_covariance(materialize(grouped, "vectors"))

    fine, coarse = (large.select(F.col("grp").alias(name)) for name in ("fine", "coarse"))
    named = (
        counts.join(fine, F.get("levels", F.lit(0)) == F.col("fine"), "left")
        .join(coarse, F.get("levels", F.lit(1)) == F.col("coarse"), "left")
        .withColumn("grp", F.coalesce("fine", "coarse", F.lit("{}")))
    )
    kept_columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = named.select(*kept_columns, "grp", *STATISTICS)
    scored = distances(rows.filter("not base_failed"), estimate).select(*kept_columns, "d2")
    failed = rows.filter("base_failed").select(*kept_columns, F.lit(None).cast("double").alias("d2"))
    return scored.unionByName(failed).withColumn("kept", ~F.col("base_failed") & (F.col("d2") <= limit))
