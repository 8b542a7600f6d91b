"""Re-parameterised benchmark items: names at sentence starts, whole numbers, runs of names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontamination

TOM = "Tom has 5 apples. Tom gives 3 to Mary. Mary eats 2 of them. Tom is sad. How many has Tom left now?"
SHOP = "The shop of Mary Ann sold 1,200 pens at 3.50 dollars each to her friend John and 40 books to a school"
CITY = "the road from Paris to the old harbour town leads over 14 hills and it ends behind the gates of Paris again"
MANY = "first box holds 12 pens and " + " ".join(f"word{chr(97 + i)}" for i in range(20)) + " second box holds 12 pens"


def found(spark, item, doc):
    docs = spark.createDataFrame([(1, doc)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    return decontamination.contaminated(docs, items).count() == 1


@pytest.mark.parametrize(("item", "doc"), [
    (TOM, TOM.replace("Tom", "Anna").replace("Mary", "Peter").replace("5", "1,005")),
    (TOM, "\n" + TOM.replace("Tom", "Mary Ann").replace("Mary", "Joe", 0)),
    (SHOP, SHOP.replace("Mary Ann", "Mary").replace("1,200", "950").replace("3.50", "4").replace("John", "Jo Lee")),
    (SHOP, "(" + SHOP.replace("Mary Ann", "Susan").replace("1,200", "7.000,5") + ")"),
])
def test_changed_slots_are_found(spark, item, doc):
    assert found(spark, item, doc)


def test_other_question_is_not_found(spark):
    assert not found(spark, TOM, "Tom has 5 pears. He sold 3 of them. How many are left now? Mary went away with all of it.")


@pytest.mark.parametrize("doc", [
    CITY.replace("from Paris", "from\nParis"),
    CITY.replace("of Paris", "of (Paris)"),
])
def test_marks_are_no_values(spark, doc):
    assert found(spark, CITY, doc)


def test_exact_windows_outlive_a_clash(spark):
    """20 of the 31 words lie between both slots; one of two equal numbers is changed."""
    assert found(spark, MANY, MANY.replace("12", "13", 1))


DOCS = [TOM, TOM.replace("Tom", "Anna").replace("3", "4"), SHOP.upper(), "12 and 7, 8 or 9", "Ann met Joe Lee", "ΑΣ'Ab ΟΔΟΣ ο", "no item of any kind", "5 apples"]


@pytest.mark.parametrize("items", [[TOM, SHOP], ["1 2 3 4"], ["Mary Ann"], ["ας'ab οδος ο", CITY], ["12 kg"], []])
def test_anchors_lose_no_window(spark, items):
    docs = spark.createDataFrame(list(enumerate([*DOCS, MANY])), "doc_id bigint, text string")
    items = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    own = items.select("item_id", decontamination.prepared(F.col("text")).alias("prepared"))
    lengths = decontamination.measured(own, decontamination.WINDOW)
    prepared = docs.select("doc_id", decontamination.prepared(F.col("text")).alias("prepared"))
    equal = {r["doc_id"] for r in decontamination.matches(prepared, lengths)[0].select("doc_id").distinct().collect()}
    kept = {r["doc_id"] for r in decontamination.anchored(docs, lengths).collect()}
    assert equal <= kept and 6 not in kept


def test_views_are_cut_for_documents_with_an_anchor_only(spark, monkeypatch):
    stored, plain = {}, decontamination.materialize

    def keep(df, name):
        stored[name] = plain(df, name)
        return stored[name]

    monkeypatch.setattr(decontamination, "materialize", keep)
    assert found(spark, TOM, TOM)
    docs = spark.createDataFrame([*enumerate(DOCS), (0, "a second text"), (None, TOM)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, SHOP)], "item_id bigint, text string")
    assert [r["doc_id"] for r in decontamination.contaminated(docs, items).collect()] == [2]
    assert {r["doc_id"] for r in stored["prepared"].collect()} == {2}
