"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by the element they stand in, tags score
negative, and a linear scan finds the contiguous region with the highest sum. The
weights are log-odds learned from labelled pages: those that mark their own main text by one
<article> or <main> element. Elements that the weights speak against are left out of the region.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import slices

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(script|style|noscript|template|svg|iframe)\b[^>]*>(?:.*?</\1\s*>|.*)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?A-Za-z][^>]*>?"
    r"|([^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
# Element names by role (fixed values).
CONTAINERS = frozenset(
    "title nav header footer aside form button select textarea label fieldset figcaption dialog menu "
    "article main section div table body ul ol dl a".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre "
    "section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
KNOWN = CONTAINERS | BLOCKS | VOID | frozenset("b i em strong span u s small sub sup code q cite abbr time mark".split())
#: Words in class, id and role that tell what an element is for (fixed values).
HINTS = tuple(
    "advert sponsor promo banner comment cookie consent notice alert popup modal menu navigation breadcrumb "
    "sidebar footer header related share social newsletter subscribe signup login search widget".split()
)
_HINT = re.compile(rf"\b(ads?|nav)\b|{'|'.join(HINTS)}", re.IGNORECASE)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
#: Weights of what no labelled page has. Unknown words speak for the main text, unknown tags against.
WORD, TAG, AGAINST = 1.0, -0.5, -2.0
UNLIKELY = frozenset("title nav header footer aside form button select textarea label fieldset dialog menu".split())
LIMIT, LEAST = 3.0, 20


def _key(name: str, attributes: str) -> str:
    hint = _HINT.search(" ".join(_NAMES.findall(attributes))) if "=" in attributes else None
    return f"{name}.{hint.group().lower()}" if hint else name


def sequence(page: str) -> list[tuple[str, str, str, bool]]:
    """(key, tag name, text, inside the marked main text) of every token; text is empty for tags.

    Marked are the insides of <article> and <main>, without unlikely elements in them. The key of words is the innermost container they stand in, with its hint and with a
    mark for links; that of a tag is its name."""
    out, stack = [], [("", "body", False)]
    opened: Counter = Counter()
    depth = aside = 0
    for m in _TOKEN.finditer(page):
        closing, name, attributes, text = m.group(2), m.group(3), m.group(4), m.group(5)
        if text is not None:
            out.append((stack[-1][1], "", text, depth > 0 and not aside))
            continue
        if name is None:
            continue
        name = name.lower()
        if closing:
            # What is open inside the element ends with it, so every element is looked at twice at most.
            while opened[name]:
                inner, _, unlikely = stack.pop()
                opened[inner] -= 1
                depth -= inner in ("article", "main")
                aside -= unlikely
                if inner == name:
                    break
        elif name in CONTAINERS and not attributes.endswith("/"):
            key = _key(name, attributes)
            outer = stack[-1][1]
            # What lies inside something unlikely stays there; lists and links belong to what is around them.
            if name in ("ul", "ol", "dl", "table", "section", "div") and "." not in key:
                key = outer if outer != "body" else key
            elif name == "a":
                key = f"{outer.removesuffix(' a')} a"
            elif name in UNLIKELY and outer.split(".")[0] in ("article", "main"):
                key = f"{outer.split(' ')[0]} {key}"
            unlikely = name in UNLIKELY or "." in key.split(" ")[-1]
            stack.append((name, key, unlikely))
            opened[name] += 1
            depth += name in ("article", "main")
            aside += unlikely
        out.append((f"<{name}" if name in KNOWN else "<other", name, "", depth > 0 and not aside))
    return out


def _labelled(page: str) -> bool:
    lower = page.lower()
    return lower.count("<article") + lower.count("<main") == 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside, outside = Counter(), Counter()
    for batch in slices(batches, "html", 8 << 20):
        for page in batch.column("html").to_pylist():
            if not _labelled(page):
                continue
            for key, name, text, marked in sequence(page):
                (inside if marked else outside)[key] += 1 if name else len(text.split())
    keys = sorted({*inside, *outside})
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), pa.array([inside[k] for k in keys], pa.int64()), pa.array([outside[k] for k in keys], pa.int64())],
        ["key", "inside", "outside"],
    )


def weights(counts: list[tuple[str, int, int]]) -> dict[str, float]:
    """Log-odds of lying inside, for keys seen often enough; tags never score above zero."""
    total_in, total_out = sum(c[1] for c in counts) + 1, sum(c[2] for c in counts) + 1
    found = {}
    for key, inside, outside in counts:
        if inside + outside < LEAST:
            continue
        odds = math.log((inside + 0.5) / total_in) - math.log((outside + 0.5) / total_out)
        odds = max(-LIMIT, min(LIMIT, odds))
        found[key] = min(-0.1, odds) if key.startswith("<") else odds
    return found


def weight(key: str, learnt: dict[str, float]) -> float:
    if key in learnt:
        return learnt[key]
    if key.startswith("<"):
        return TAG
    parts = key.split()
    if any("." in part or part in UNLIKELY for part in parts):
        return AGAINST
    return -WORD if key.endswith(" a") and parts[0] not in ("article", "main") else WORD


def main_text(page: str, learnt: dict[str, float]) -> str:
    tokens = sequence(page)
    scores = {key: weight(key, learnt) for key, *_ in tokens}
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, (key, name, text, _) in enumerate(tokens):
        if total <= 0:
            total, start = 0.0, i
        total += scores[key] * (1 if name else len(text.split()))
        if total > best:
            best, span = total, (start, i + 1)
    blocks: list[list[str]] = [[]]
    for key, name, text, _ in tokens[slice(*span)]:
        if name:
            if name in BLOCKS:
                blocks.append([])
        elif scores[key] > 0:
            blocks[-1].append(text)
    lines = (" ".join(html.unescape("".join(block)).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    Null and empty pages, and pages without a scoring region, have an empty text. Repeated
    rows get repeated results, null ids and urls stay null, further columns are not read. The
    weights come to the driver: one number per element name and hint, both from fixed lists.
    """
    plain = pages.select(
        F.col(id_column).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("html")
    )
    counted = plain.select("html").mapInArrow(_count, "key string, inside bigint, outside bigint")
    counted = counted.groupBy("key").agg(F.sum("inside"), F.sum("outside")).collect()
    learnt = weights([tuple(row) for row in counted])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 8 << 20):
            texts = [main_text(page, learnt) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = [plain.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return plain.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
