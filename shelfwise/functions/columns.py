"""Scalar expressions: text fields, dates, similarity formulas, recommendation structs."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shelfwise import settings


def field(text: Column, separator: str, index: int) -> Column:
    """Field ``index`` of a text split on a literal separator; null when missing."""
    return F.get(F.split(text, rf"\Q{separator}\E"), F.lit(index))


def number(text: Column, kind: str, strict: bool) -> Column:
    """Parse a trimmed number; junk fails the job when strict, else gives null.

    Text that is only blanks counts as junk, and so does a decimal point in an
    integer, which a plain cast would let through.
    """
    trimmed = F.trim(text)
    if kind == "int":
        trimmed = F.when(trimmed.rlike(r"^[+-]?\d+$"), trimmed)
    parsed = trimmed.try_cast(kind)
    if not strict:
        return parsed
    message = F.concat(F.lit(f"not a valid {kind}: "), F.coalesce(text, F.lit("<missing>")))
    return F.coalesce(parsed, F.raise_error(message).cast(kind))


def year_month(epoch_seconds: Column, zone: str = "UTC") -> Column:
    """Epoch seconds to an int such as 202112, whatever the session zone is."""
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    moment = F.timestamp_add("SECOND", epoch_seconds, start)
    if zone != "UTC":
        moment = F.convert_timezone(F.lit("UTC"), F.lit(zone), moment)
    return F.year(moment) * 100 + F.month(moment)


def register_sql_functions(spark: SparkSession) -> None:
    """Make the month expression callable from SQL text as ``year_month(ts)``."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION year_month(ts INT) RETURNS INT RETURN "
        "year(timestampadd(SECOND, ts, timestamp_ntz'1970-01-01 00:00:00')) * 100 + "
        "month(timestampadd(SECOND, ts, timestamp_ntz'1970-01-01 00:00:00'))"
    )


def tags_text(tags: Column) -> Column:
    """Tags with each bar replaced by a blank."""
    return F.translate(F.coalesce(tags, F.lit("")), "|", " ")


def tokens(text: Column) -> Column:
    """Lower-case words split on single blanks; doubled blanks give an empty token."""
    return F.split(F.lower(text), r"\s")


def inverse_document_frequency(documents: Column, holders: Column) -> Column:
    return F.log((documents + 1) / (holders + 1))


def cooccurrence_score(together: Column, count1: Column, count2: Column) -> Column:
    """Shared raters over the geometric mean of both counts, in double throughout."""
    return together / F.sqrt(count1.cast("double") * count2.cast("double"))


def trend(ups: Column, downs: Column) -> Column:
    """log10 of the good ratings minus log10 of the others; none counts as one."""
    return F.log10(F.greatest(ups, F.lit(1))) - F.log10(F.greatest(downs, F.lit(1)))


def payload(line: Column, prefix: str = settings.LOG_PREFIX) -> Column:
    """Trimmed text after the prefix, up to a second prefix if there is one."""
    return F.trim(field(line, prefix, 1))


def recommendation(product: Column, score: Column) -> Column:
    return F.struct(
        product.cast("int").alias("productId"), score.cast("double").alias("score")
    )


def recommended_ids(recs: Column) -> Column:
    """Product ids of a recommendation array, in order."""
    return F.transform(recs, lambda rec: rec["productId"])


def recs_map(recs: Column) -> Column:
    """Recommendation array as a map from product id to score."""
    return F.map_from_entries(recs)


def history_key(user: Column) -> Column:
    """Key of a user's recent-rating list, such as ``userId:17``."""
    return F.concat(F.lit("userId:"), user.cast("string"))


def history_item(text: Column, strict: bool = True) -> Column:
    """``productId:score`` text of a recent-rating list as a recommendation struct."""
    return recommendation(
        number(field(text, ":", 0), "int", strict), number(field(text, ":", 1), "double", strict)
    )
