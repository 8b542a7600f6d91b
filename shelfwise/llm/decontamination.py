"""Benchmark items in documents, also with other numbers, names and units.

Both sides are canonicalised: words in lower case without punctuation, and typed placeholders
for numbers with their separators, for units behind a number, and for runs of names: in one view
capitalised words inside a sentence, in another all capitalised words. Windows of the canonical
words are hash-joined view by view. Where a matched window has placeholders, each value of the
item must stand for one value of the document throughout. Functions of Spark SQL only.

Only documents that can hold a window are read in all views: each window of an item has an anchor, its longest
run of words that are the same in every view, and a document without any anchor has no equal window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import broadcast_if_small, id_and_text
from shelfwise.sources.tables import materialize

WINDOW = 10
#: An item is found where so many percent of its windows are.
PERCENT = 40
#: Words of the longest anchor.
ANCHOR = 5
#: Marks inside a prepared text, from the private use area: of a name inside a sentence, of a unit, of
#: another capitalised word (a name or the start of a sentence), and what joins a run of names or a number.
NAME, UNIT, MAYBE, JOIN, POINT = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"
#: The readings of a text: plain words; whole numbers; names, too; all capitalised words as names.
PLAIN, NUMBERS, NAMES, CAPITALS = VIEWS = range(4)
#: Units that count as such behind a number (fixed values).
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms "
    "ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons s sec second "
    "seconds min minute minutes h hour hours day days week weeks month months year years dollar "
    "dollars euro euros cent cents percent degree degrees"
)


def prepared(text: Column) -> Column:
    """Lower case with marks before names, other capitalised words and units, and with joined
    runs of names and parts of numbers."""
    text = F.translate(text, NAME + UNIT + MAYBE + JOIN + POINT, " " * 5)
    marked = F.regexp_replace(text, "(?<![\\p{L}\\p{N}])(?=\\p{Lu}\\p{Ll})", MAYBE)
    marked = F.regexp_replace(marked, f"(?<=[\\p{{L}}\\p{{N}},;] ){MAYBE}", NAME)
    marked = F.regexp_replace(marked, f"([{NAME}{MAYBE}][\\p{{L}}\\p{{N}}]+)[\\s'’-]{{1,3}}(?=[{NAME}{MAYBE}])", f"$1{JOIN}")
    units = f"(?<=[0-9]) ?(?=(?:{'|'.join(UNITS.split())})(?![\\p{{L}}\\p{{N}}]))"
    numbers = F.regexp_replace(F.lower(marked), "(?<=\\p{N})[.,'’:/](?=\\p{N})", POINT)
    return F.regexp_replace(numbers, units, f" {UNIT}")


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[^\\p{{L}}\\p{{N}}{NAME}{UNIT}{JOIN}{POINT}]+"), lambda w: w != "")


def folded(text: Column, view: int) -> Column:
    """A prepared text in which each number and each run of names of the view is one word."""
    if view == PLAIN:
        return F.translate(text, JOIN + POINT + NAME + MAYBE, "  ")
    if view == NUMBERS:
        return F.translate(text, JOIN + NAME + MAYBE, " ")
    if view == NAMES:
        return F.regexp_replace(text, f"{JOIN}?{MAYBE}([\\p{{L}}\\p{{N}}]+){JOIN}?", " $1 ")
    return F.translate(text, MAYBE, NAME)


def canonical(text: Column, view: int) -> Column:
    """A prepared text with the placeholders of the view, one for each word of the folded text."""
    # Without conditions on the text: each would evaluate what stands before it again.
    text = folded(text, view)
    if view in (NAMES, CAPITALS):
        text = F.regexp_replace(text, f"{NAME}[\\p{{L}}\\p{{N}}{NAME}{JOIN}]+", NAME)
    text = F.regexp_replace(text, f"{UNIT}\\p{{L}}+", UNIT)
    return F.regexp_replace(text, f"\\p{{N}}+(?:{POINT}\\p{{N}}+)*", "0")


def bare(words: Column) -> Column:
    """Words as they were, without marks."""
    return F.transform(words, lambda w: F.translate(w, JOIN + POINT + NAME + UNIT, "  "))


def window_hashes(tokens: Column, width: int) -> Column:
    return F.when(
        F.size(tokens) >= width,
        F.transform(F.sequence(F.lit(1), F.size(tokens) - (width - 1)), lambda i: F.xxhash64(F.slice(tokens, i, width))),
    )


def _windows(texts: DataFrame, key: str, width: int, view: int) -> DataFrame:
    """(key, place, window) of every window of one view; places count from 0."""
    tokens = texts.select(key, words(canonical(F.col("prepared"), view)).alias("tokens"))
    hashed = tokens.select(key, window_hashes(F.col("tokens"), width).alias("hashes"))
    # The outer form: for the inner one, Spark infers a filter on the array and moves it below
    # the projections, where the words would be cut anew for every window.
    return hashed.select(key, F.posexplode_outer("hashes").alias("place", "window")).filter("window is not null")


def _document_windows(docs: DataFrame, width: int) -> list[DataFrame]:
    """The windows of all views, those of views that read a text alike only once: ``views`` is the
    list of views that a row stands for."""
    changes = {NUMBERS: F.col("prepared").contains(POINT), NAMES: F.col("prepared").rlike(f"[{NAME}{JOIN}]"), CAPITALS: F.col("prepared").contains(MAYBE)}
    parts = []
    for view in VIEWS:
        own = docs.filter(changes[view]) if view else docs
        same, alike = F.lit(True), [F.lit(view)]
        for later in range(view + 1, len(VIEWS)):
            same = same & ~changes[later]
            alike.append(F.when(same, F.lit(later)))
        own = own.select(F.struct("doc_id", F.array_compact(F.array(*alike)).alias("views")).alias("key"), "prepared")
        parts.append(_windows(own, "key", width, view).select("key.doc_id", "key.views", "place", "window"))
    return parts


def _union(parts: list[DataFrame]) -> DataFrame:
    return parts[0] if len(parts) == 1 else parts[0].unionByName(_union(parts[1:]))


def _item_windows(items: DataFrame, width: int, view: int) -> DataFrame:
    """item_id, item_place, window, and ``plain``, the place of the window's first word in the plain view."""
    cut = items.select("item_id", words(folded(F.col("prepared"), view)).alias("parts"), "prepared")
    key = F.struct("item_id", F.transform("parts", lambda w: F.length(w) - F.length(F.translate(w, JOIN + POINT, "")) + 1).alias("n"))
    met = _windows(cut.select(key.alias("key"), "prepared"), "key", width, view)
    before = F.aggregate(F.slice("key.n", F.lit(1), F.col("place")), F.lit(0), lambda total, n: total + n)
    return met.select("key.item_id", F.col("place").alias("item_place"), "window", before.alias("plain")).distinct()


def measured(items: DataFrame, window: int) -> DataFrame:
    """(item_id, prepared, view, width) for every view in which an item has a word."""
    lengths = [
        items.select("*", F.lit(view).alias("view"), F.least(F.lit(window), F.size(words(canonical(F.col("prepared"), view)))).alias("width"))
        for view in VIEWS
    ]
    return materialize(_union(lengths).filter("width > 0"), "items")


def _letters(text: Column) -> Column:
    """One form of the letter whose lower case depends on what stands beside it."""
    return F.replace(text, F.lit("ς"), F.lit("σ"))


def _anchors(lengths: DataFrame) -> DataFrame:
    """(words, hash, numbers) of every window of the items: the number of words and the hash of its anchor, no words
    and null where it has no plain word, and the number of its words with digits."""
    parts = []
    for view in VIEWS:
        own = lengths.filter(F.col("view") == view)
        parts.append(own.select(words(canonical(F.col("prepared"), view)).alias("tokens"), "width"))
    starts = F.sequence(F.lit(1), F.size("tokens") - F.col("width") + 1)
    cut = _union(parts).select("tokens", "width", F.explode(starts).alias("at")).select(F.expr("slice(tokens, at, width)").alias("tokens"))
    cut = cut.distinct()
    runs = F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(ANCHOR)),
        lambda n: F.transform(F.sequence(F.lit(1), F.size("tokens")), lambda i: F.slice("tokens", i, n)),
    ))
    plain = F.filter(runs, lambda run: F.forall(run, lambda w: w.rlike("^\\p{L}+$")))
    # The longest run, by words and then by letters: windows beside each other mostly share it.
    best = F.array_max(F.transform(plain, lambda run: F.struct(F.size(run).alias("n"), F.length(F.array_join(run, "")).alias("letters"), run.alias("run"))))
    numbers = F.size(F.filter("tokens", lambda w: w.contains("0")))
    found = cut.select(best.alias("best"), numbers.alias("numbers"))
    hashed = F.xxhash64("best.n", *[_letters(F.get("best.run", F.lit(i))) for i in range(ANCHOR)])
    return found.select(F.coalesce("best.n", F.lit(0)).alias("words"), F.when(F.col("best").isNotNull(), hashed).alias("hash"), "numbers").distinct()


def anchored(docs: DataFrame, lengths: DataFrame) -> DataFrame:
    """The ids of all documents that can have a window equal to one of an item, in any view; ``docs`` has a column ``text``.

    Words of letters only that follow each other in a view follow each other in the text, too. Windows without one
    are of numbers, units and names: they need a document with as many numbers, or with a capitalised word or a number.
    """
    known = materialize(_anchors(lengths), "anchors")
    # At most one row for each length of an anchor.
    sizes = {row["words"]: row["numbers"] for row in known.groupBy("words").agg(F.min("numbers").alias("numbers")).collect()}
    fewest = sizes.pop(0, None)
    parts = []
    if sizes:
        hashes = known.filter("hash is not null").select("hash").distinct()
        hashes = broadcast_if_small(hashes, hashes.count(), 16)
        most = max(sizes)
        cut = docs.select("doc_id", F.split(_letters(F.lower("text")), "\\P{L}+").alias("w"))
        beside = F.arrays_zip(*[F.slice("w", F.lit(i + 1), F.size("w")) for i in range(most)])
        cut = cut.select("doc_id", beside.alias("beside"))
        # Outer forms: see _windows.
        cut = cut.select("doc_id", F.inline_outer("beside")).toDF("doc_id", *[f"w{i}" for i in range(most)])
        own = F.array(*[F.xxhash64(F.lit(n), *[f"w{i}" for i in range(n)]) for n in sorted(sizes)])
        parts.append(cut.select("doc_id", F.explode_outer(own).alias("hash")).join(hashes, "hash", "left_semi").select("doc_id"))
    if fewest == 0:
        parts.append(docs.filter(F.col("text").rlike("\\p{Lu}\\p{Ll}|\\p{N}")).select("doc_id"))
    elif fewest is not None:
        parts.append(docs.filter(F.size(F.split("text", "\\p{N}+")) > fewest).select("doc_id"))
    return _union(parts).distinct() if parts else docs.filter("false").select("doc_id")


def matches(docs: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, item_id, view, width, place, item_place, plain) where canonical windows are equal, and
    (item_id, view, width, item_windows). ``docs`` has a column ``prepared``, ``lengths`` is of ``measured``.

    Items of fewer words than the window are matched by one window of their length.
    """
    widths: dict[int, list[int]] = {}  # at most ``window`` numbers, each with at most four views
    for width, view in sorted(lengths.select("width", "view").distinct().collect()):
        widths.setdefault(width, []).append(view)
    found, sizes = [], []
    for width, views in widths.items():
        own = lengths.filter(F.col("width") == width)
        known = [_item_windows(own.filter(F.col("view") == view), width, view).withColumn("view", F.lit(view)) for view in views]
        known = materialize(_union(known), "windows")
        sizes.append(known.groupBy("item_id", "view").agg(F.countDistinct("item_place").alias("item_windows")).withColumn("width", F.lit(width)))
        known = broadcast_if_small(known, known.count(), 64)
        for part in _document_windows(docs, width):
            met = part.join(known, "window").filter(F.array_contains("views", F.col("view")))
            found.append(met.select("doc_id", "item_id", "view", F.lit(width).alias("width"), "place", "item_place", "plain"))
    if not found:
        empty = "doc_id bigint, item_id bigint, view int, width int, place int, item_place int, plain int"
        return docs.sparkSession.createDataFrame([], empty), docs.sparkSession.createDataFrame([], "item_id bigint, view int, item_windows bigint, width int")
    return _union(found).distinct(), _union(sizes)


def _values(texts: DataFrame, key: str, found: DataFrame, place: str, value: str) -> DataFrame:
    """The found rows with the folded words of their window."""
    views = F.array(*[F.struct(F.lit(view).alias("view"), words(folded(F.col("prepared"), view)).alias("tokens")) for view in VIEWS])
    tokens = texts.select(key, F.explode(views).alias("read")).select(key, "read.view", "read.tokens")
    return found.join(tokens, [key, "view"]).withColumn(value, F.slice("tokens", F.col(place) + 1, F.col("width"))).drop("tokens")


def consistent(found: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The found rows without those that hold only by inconsistent placeholders.

    An alignment is a document, an item, a view and a shift. Where a slot value of the item stands for
    two values of the document in it, its windows with changed values go, and of those that are
    equal word by word the ones that hold such a slot. Values are compared without marks.
    """
    slots = found.filter("slots")
    group = ["doc_id", "item_id", "view", "width", "shift"]
    ids = materialize(slots.select("doc_id").distinct(), "slot-docs")
    near = docs.join(broadcast_if_small(ids, ids.count(), 32), "doc_id", "left_semi")
    both = _values(items, "item_id", _values(near, "doc_id", slots, "place", "doc_words"), "item_place", "item_words")
    both = both.select(
        *group[:4], F.expr("place - item_place").alias("shift"), "place", "item_place",
        F.transform("item_words", lambda w: w.rlike(f"^[{NAME}{UNIT}]|\\p{{N}}")).alias("typed"),
        bare(F.col("item_words")).alias("item_words"), bare(F.col("doc_words")).alias("doc_words"),
    )
    both = materialize(both, "slot-windows")
    pairs = both.select(*group, F.explode(F.arrays_zip("typed", "item_words", "doc_words")).alias("pair")).filter("pair.typed")
    clashing = (
        pairs.groupBy(*group, "pair.item_words").agg(F.countDistinct("pair.doc_words").alias("values")).filter("values > 1")
        .groupBy(*group).agg(F.collect_set("item_words").alias("clash"))
    )
    held = F.exists(F.arrays_zip("typed", "item_words"), lambda x: x["typed"] & F.array_contains("clash", x["item_words"]))
    rejected = both.join(clashing, group).withColumn("bad", held | (F.col("item_words") != F.col("doc_words")))
    key = [*group[:4], "place", "item_place"]
    # Texts that repeat an id: one reading that holds is enough.
    rejected = rejected.groupBy(*key).agg(F.min("bad").alias("bad")).filter("bad").select(*key)
    return found.join(rejected, key, "left_anti")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", item_column: str = "item_id",
    text: str = "text", window: int = WINDOW, percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, item_id, matched_windows, item_windows) of each benchmark item that a document holds.

    Null texts and texts or items without a word hold and are nothing; rows with a null id are
    not looked at. Documents or items that repeat an id count once, by what all their rows hold. An empty table gives no row;
    further columns are not read.
    """
    items = id_and_text(benchmark, item_column, text).filter("doc_id is not null")
    items = items.select(F.col("doc_id").alias("item_id"), prepared(F.col("text")).alias("prepared"))
    items = materialize(items.distinct(), "benchmark")
    lengths = measured(items, window)
    whole = id_and_text(docs, id_column, text).filter("doc_id is not null and text <> ''")
    # All rows of an id stay together: values of its slots are compared over all of them.
    near = materialize(anchored(whole, lengths), "anchored")
    whole = whole.join(broadcast_if_small(near, near.count(), 32), "doc_id", "left_semi")
    whole = whole.select("doc_id", prepared(F.col("text")).alias("prepared"))
    whole = materialize(whole, "prepared")
    found, sizes = matches(whole, lengths)
    templated = items.select("item_id", F.col("prepared").rlike(f"[{NAME}{MAYBE}{UNIT}]|\\p{{N}}").alias("slots"))
    templated = templated.groupBy("item_id").agg(F.max("slots").alias("slots"))
    found = materialize(found.join(templated, "item_id"), "matches")
    if not found.filter("slots").isEmpty():
        found = consistent(found, whole, items)
    # By the windows of each view, and by the plain windows at whose first word any view has one.
    counted = found.groupBy("doc_id", "item_id", "view", "width").agg(F.countDistinct("item_place").alias("matched_windows"))
    plain = sizes.filter(F.col("view") == PLAIN).drop("view", "width")
    starts = found.join(plain, "item_id").filter("plain < item_windows")
    together = starts.groupBy("doc_id", "item_id", "item_windows").agg(F.countDistinct("plain").alias("matched_windows"))
    either = counted.join(sizes, ["item_id", "view", "width"]).select("doc_id", "item_id", "matched_windows", "item_windows")
    return (
        either.unionByName(together)
        .filter(100 * F.col("matched_windows") >= percent * F.col("item_windows"))
        .groupBy("doc_id", "item_id")
        .agg(F.max("matched_windows").alias("matched_windows"), F.max("item_windows").alias("item_windows"))
    )
