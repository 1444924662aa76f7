"""Main text of web pages by differencing each page with its nearest URLs.

Pages of one host are put in the order of their URL paths. Each page's text lines are
aligned with those of the ``NEAREST`` pages before and after it by a longest common
subsequence. A line that most of them share is template text and goes, whatever element
it is in, unless the markup spares it. A page whose other text is the same too, but for a
title or a date, is a copy and no witness: it says nothing about template lines.

The markup then confirms or spares. Lines in menus, page headers, footers, sidebars,
notices, adverts, forms and comments are never article text, also where every page has
others; lines inside an article or main element are, also where other pages quote or copy
them. A class counts as such a mark only if all words of one of its names say so and no
other name of the element says it is content; what classes alone mark is left to the
differencing if it would be most of a page without an article.

Order and neighbours don't depend on partitions: the first and last keys of each range of
the ordered pages are collected, ``2 * NEAREST`` for each range, and pages there also go
to the ranges next to them. There are as many ranges as the input has partitions, so they
hold pages of several hosts or a part of one, and no task holds a whole host.

Null or empty html and pages without main text give an empty text. Null urls count as
one host without a path. Repeated rows are pages of their own, but not each other's
template. Unclosed elements, cut-off tags and stray angle brackets don't fail. A page of
any length is taken whole; aligning n and m of its lines takes n * m bits. An empty table
gives an empty one; other columns can have any name.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter, defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_by_value

ship_by_value(__name__)

# Fixed values of HTML: elements that start a block, and elements whose text is never shown.
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section
    summary table tbody thead tfoot tr caption ul title""".split()
)
SILENT = "script|style|noscript|template|iframe|textarea|select|svg|title|object|canvas"
SPACED = frozenset(["br", "td", "th", "wbr"])
# Elements, roles and words in a class or id that mark a part of the page as no article text.
ASIDE = frozenset("nav footer aside form button menu dialog".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu".split())
ASIDE_WORDS = frozenset(
    """ad ads adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion
    cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe
    subscription signup sidebar rail widget menu nav navbar navigation breadcrumb breadcrumbs footer
    header masthead topbar toolbar comment comments disqus respond reply replies discussion share sharing
    social related recommended recommendations pagination pager login search copyright disclaimer""".split()
)
OWN_WORDS = frozenset("article post entry content story main body title headline".split())
# Words that say where or how big an element is, not what it holds.
PLACE_WORDS = frozenset(
    """area bar block bottom box center column container desktop first fixed global group inner item items large
    left link links list main mobile outer page panel primary right secondary second section site small sticky
    text third title top wrap wrapper content body header""".split()
)
COMMENT_WORDS = frozenset("comment comments disqus respond reply replies discussion".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<silent>{SILENT})\b[^>]*(?:>.*?(?:</(?P=silent)\s*[^>]*(?:>|\Z)|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[/!?][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORD = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE, MAIN, TEMPLATE, CLASSED = 0, 1, 2, 3
# Pages before and after a page that it is aligned with.
NEAREST = 2
# Two pages differ if both have this much text that they don't share, or this share of theirs.
OTHER_CHARS, OTHER_SHARE = 200, 0.3


def _own_words(value: str) -> list[str]:
    """Words of a class or id that name the element, not what it has, lacks or has open."""
    words = WORD.findall(value)
    if words and words[-1] in ("open", "closed"):
        return []
    return words[: next((i for i, x in enumerate(words) if x in ("has", "with", "no", "without")), len(words))]


def _named(value: str, in_main: bool) -> tuple[bool, bool, bool]:
    """Whether one name of a class or id marks no article text, reader comments, or content."""
    words = _own_words(value)
    aside = [w for w in words if w in ASIDE_WORDS]
    if not aside:
        return False, False, bool(words) and words[-1] in OWN_WORDS
    if not all(w in ASIDE_WORDS or w in PLACE_WORDS or w in OWN_WORDS for w in words):
        return False, False, False
    if set(aside) == {"header"} and (in_main or any(w in OWN_WORDS for w in words)):
        return False, False, False
    return True, any(w in COMMENT_WORDS for w in aside), False


def _marks(name: str, rest: str, in_main: bool) -> tuple[int, bool]:
    """OUTSIDE, TEMPLATE or CLASSED for an element, and whether it holds reader comments."""
    aside, classed, comments, content = name in ASIDE or (name == "header" and not in_main), False, False, False
    if rest.strip():
        for key, *values in ATTRIBUTE.findall(rest):
            key, value = key.lower(), "".join(values).lower()
            if key in ("class", "id"):
                for one in value.split():
                    says_aside, says_comments, says_content = _named(one, in_main)
                    classed |= says_aside
                    comments |= says_comments
                    content |= says_content
            elif key == "role":
                aside |= value in ASIDE_ROLES
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                aside = True
            elif key == "style":
                aside |= "display:none" in value.replace(" ", "")
    if aside:
        return TEMPLATE, comments
    if name in ("body", "html", "main"):
        return OUTSIDE, comments
    # Of articles only those of readers are marked by a class.
    return (TEMPLATE if comments else CLASSED if classed and not content and name != "article" else OUTSIDE), comments


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """The page's text blocks in order, each with OUTSIDE, MAIN or TEMPLATE."""
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    main = 0
    skipped, depth, mark, comments = "", 0, OUTSIDE, False

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                lines.append((text, mark if skipped else MAIN if main else OUTSIDE))
            parts.clear()

    for token in TOKEN.finditer(page or ""):
        if token["text"] is not None:
            parts.append(token["text"])
            continue
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name in SPACED:
            parts.append(" ")
        elif name in BLOCKS:
            end_block()
        if token["close"]:
            if name in BLOCKS:
                pass
            elif skipped == name:
                end_block()
            if skipped == name:
                depth -= 1
                if not depth:
                    skipped, comments = "", False
            elif name in ("article", "main"):
                main = max(0, main - 1)
        elif name not in VOID and not token["rest"].endswith("/"):
            kind, of_readers = _marks(name, token["rest"], main > 0)
            if skipped and name in ("article", "main") and not (comments or kind or main):
                skipped, depth = "", 0  # an unclosed part before the article ends here
            if not skipped and kind:
                end_block()
                skipped, depth, mark, comments = name, 1, kind, of_readers
            elif skipped == name:
                depth += 1
            if not skipped and name in ("article", "main"):
                main += 1
    end_block()
    size = Counter()
    for text, kind in lines:
        size[kind] += len(text)
    # Comments apart, a class alone doesn't take most of a page that names no article.
    spared = not size[MAIN] and size[CLASSED] > size[OUTSIDE]
    return [(text, (OUTSIDE if spared else TEMPLATE) if kind == CLASSED else kind) for text, kind in lines]


def common_lines(mine: list[str], other: list[str]) -> set[int]:
    """Positions of ``mine`` in a longest common subsequence of the two lists."""
    start, ends = 0, 0
    most = min(len(mine), len(other))
    while start < most and mine[start] == other[start]:
        start += 1
    while ends < most - start and mine[-1 - ends] == other[-1 - ends]:
        ends += 1
    found = set(range(start)) | set(range(len(mine) - ends, len(mine)))
    middle, theirs = mine[start : len(mine) - ends], other[start : len(other) - ends]
    both = set(middle) & set(theirs)
    a = [i for i, x in enumerate(middle) if x in both]
    b = [x for x in theirs if x in both]
    places: dict[str, int] = defaultdict(int)
    for j, x in enumerate(b):
        places[x] |= 1 << j
    # Bit j of row i is 0 where the first i lines of a have one more in common with j + 1 of b than with j.
    every = (1 << len(b)) - 1
    rows = [every]
    for i in a:
        row = rows[-1]
        met = row & places[middle[i]]
        rows.append(((row + met) | (row - met)) & every)
    i, j = len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif (rows[i - 1] & ((1 << j) - 1)).bit_count() == (rows[i] & ((1 << j) - 1)).bit_count():
            i -= 1
        else:
            i, j = i - 1, j - 1
            found.add(start + a[i])
    return found


def _differs(lines: list[str], kinds: bytes, shared: set[int]) -> bool:
    """Whether a page has enough text, apart from what the markup marks, that it doesn't share."""
    own = [len(x) for x, kind in zip(lines, kinds, strict=True) if kind != TEMPLATE]
    other = sum(len(x) for i, x in enumerate(lines) if kinds[i] != TEMPLATE and i not in shared)
    return other >= OTHER_CHARS or other >= OTHER_SHARE * max(sum(own), 1)


def template_lines(lines: list[str], kinds: bytes, neighbours: list[tuple[list[str], bytes]]) -> set[int]:
    """Lines that most of the nearest pages share, of those whose other lines differ."""
    votes: Counter[int] = Counter()
    witnesses = 0
    for others, other_kinds in neighbours:
        shared = common_lines(lines, others)
        if not shared:
            witnesses += 1
            continue
        theirs = common_lines(others, lines)
        if _differs(lines, kinds, shared) and _differs(others, other_kinds, theirs):
            witnesses += 1
            votes.update(shared)
    return {i for i, n in votes.items() if 2 * n > witnesses}


def main_text(lines: list[str], kinds: bytes, neighbours: list[tuple[list[str], bytes]]) -> str:
    """The lines that are article text, joined by blank lines."""
    shared = template_lines(lines, kinds, neighbours)
    return "\n\n".join(
        x for i, x in enumerate(lines) if kinds[i] == MAIN or (kinds[i] == OUTSIDE and i not in shared)
    )


def _keyed(pages: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    return pages.withColumns(
        {
            "host": F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)),
            "path": F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1),
            "tie": F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        }
    )


ORDER = ["host", "path", "tie"]


def range_edges(keys: DataFrame, ranges: int) -> list[tuple[list[tuple], list[tuple]]]:
    """The first and the last ``NEAREST`` keys of each range, by range: the only rows that are collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = [], deque(maxlen=NEAREST)
        for batch in batches:
            own = [tuple(row.values()) for row in batch.to_pylist()]
            first += own[: NEAREST - len(first)]
            last.extend(own[-NEAREST:])
        kinds = [*[pa.string()] * 3, pa.bool_()]
        rows = [*[(*x, False) for x in first], *[(*x, True) for x in last]]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*ORDER, "at_end"])

    ordered = keys.repartitionByRange(ranges, *ORDER).sortWithinPartitions(*ORDER)
    found = ordered.mapInArrow(run, "host string, path string, tie string, at_end boolean")
    edges: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
    for row in found.withColumn("range", F.spark_partition_id()).collect():
        edges[row["range"]][row["at_end"]].append((row["host"], row["path"], row["tie"]))
    return sorted((sorted(first), sorted(last)) for first, last in edges.values())


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, main text and n_chars of every row of ``pages``."""
    rows = pages.select(
        pages[page_id].alias("page_id"), pages[url].alias("url"), pages[source].alias("html")
    )
    ranges = max(rows.rdd.getNumPartitions(), pages.sparkSession.sparkContext.defaultParallelism)
    edges = range_edges(_keyed(rows.select("page_id", "url")).select(*ORDER), ranges)
    lows = [first[0] for first, _ in edges]

    def places(own: tuple) -> list[tuple[int, bool]]:
        """The range of a page, and the ranges where it is only a neighbour."""
        at = max(bisect_right(lows, own) - 1, 0)
        out = [(at, False)]
        # It is a neighbour in the next ranges while fewer than NEAREST pages lie between, and before alike.
        for step, side in ((1, 1), (-1, 0)):
            near, i = edges[at][side], at
            passed = len(near) - near.index(own) - 1 if side and own in near else near.index(own) if own in near else NEAREST
            while passed < NEAREST and 0 <= i + step < len(edges):
                i += step
                out.append((i, True))
                passed += len(edges[i][side])
        return out

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            out: list[tuple] = []
            for i, page in enumerate(columns["html"]):
                found = page_lines(page)
                own = tuple(columns[name][i] for name in ORDER)
                row = (columns["page_id"][i], columns["url"][i], *own, [x for x, _ in found], bytes(k for _, k in found))
                out += [(at, copy, *row) for at, copy in places(own)]
            names = ["range", "copy", "page_id", "url", *ORDER, "lines", "kinds"]
            kinds = [pa.int32(), pa.bool_(), batch.schema.field("page_id").type, pa.string(), *[pa.string()] * 3, pa.list_(pa.string()), pa.binary()]
            values = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.record_batch([pa.array(list(v), k) for v, k in zip(values, kinds, strict=True)], names)

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        kind = pa.int64()

        def finished() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * 4
            kinds = [kind, pa.string(), pa.string(), pa.int64()]
            made = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            done.clear()
            return pa.record_batch(made, ["page_id", "url", "text", "n_chars"])

        def decide(near: list[dict], at: int) -> None:
            row = near[at]
            beside = [x for x in (*near[max(0, at - NEAREST) : at], *near[at + 1 : at + 1 + NEAREST]) if x is not row]
            others = [x for x in beside if (x["range"], x["host"]) == (row["range"], row["host"])]
            text = main_text(row["lines"], row["kinds"], [(x["lines"], x["kinds"]) for x in others])
            done.append((row["page_id"], row["url"], text, len(text)))

        window: deque[dict] = deque(maxlen=2 * NEAREST + 1)
        waiting = 0  # rows at the window's end that have no decision yet
        for batch in batches:
            kind = batch.schema.field("page_id").type
            for row in batch.to_pylist():
                window.append(row)
                waiting += 1
                if waiting > NEAREST:
                    at = len(window) - waiting
                    waiting -= 1
                    if not window[at]["copy"]:
                        decide(list(window), at)
                if len(done) >= 500:
                    yield finished()
        for at in range(len(window) - waiting, len(window)):
            if not window[at]["copy"]:
                decide(list(window), at)
        if done:
            yield finished()

    name = rows.schema["page_id"].dataType.simpleString()
    ordered = "range int, copy boolean, page_id {0}, url string, host string, path string, tie string"
    parsed = _keyed(rows).mapInArrow(parse, f"{ordered}, lines array<string>, kinds binary".format(name))
    sorted_rows = parsed.repartition(ranges, "range").sortWithinPartitions("range", *ORDER)
    return sorted_rows.mapInArrow(difference, f"page_id {name}, url string, text string, n_chars bigint")
