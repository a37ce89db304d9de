"""Main text of web pages by nearest-URL page differencing.

Pages of one host are ordered by URL path; a page's nearest neighbour is the one
before or after it that shares the longer beginning of the path.  The text
lines (blocks) of a page are aligned with its neighbour's by a longest common
subsequence, and shared lines are what the site repeats around its texts.

Differencing alone is wrong both ways: menus, adverts and footers that differ
on every page are not shared, and copies of an article share its lines.  So markup
decides where it speaks, and the shared lines go wherever it leaves a line open:

* lines in elements that are furniture by tag, role or name (navigation, page header,
  footer, sidebar, form, advert, notice, comments, hidden ...) never stay;
* where a page has an ``article`` with text, its lines stay, but for shared lines made of links alone;
  lines of ``main`` around it stay unless shared, lines outside go;
* where it has a ``main`` with text but no article, the same holds for ``main``;
* on other pages every line stays unless shared; where all of them are shared, the
  page is a copy of its neighbour and all stay.

Order of work: lines and their hashes are made in tasks; one row of hashes a
path is sorted by range over (host, path), so a hot host spreads over many tasks,
and the last row before and the first row behind each range are added to it; each page then
meets the hashes of its two neighbours.
"""

from __future__ import annotations

import html
import math
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.batches import append_columns, col, map_batches, save_and_reread

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'<>])*)>|<(/?)([A-Za-z][^\s/<>]*)[^<>]*>|<[!?/][^>]*(?:>|\Z)""",
                 re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""")

#: Attributes that tell what an element is for.
TELLING = re.compile(r"class|\bid\b|role|style|hidden|itemprop", re.IGNORECASE)

# Elements of HTML by kind.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements that are never part of the article.
FURNITURE_TAGS = frozenset("""aside audio button canvas datalist dialog embed footer form head iframe input map menu nav noembed
    noframes noscript object script search select style svg template textarea title video""".split())
#: Names in ``class`` and ``id`` that mark furniture.
FURNITURE_NAMES = frozenset("""ad ads adsbygoogle adslot advert advertisement advertising adverts alert banner breadcrumb breadcrumbs
    comment commentlist comments consent cookie cookies copyright disqus footer gdpr header hidden login masthead menu menubar
    modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promotion recommended related
    replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar
    topbar widget widgets""".split())
#: A header or footer of one of these is the article's own.
ARTICLE_NAMES = frozenset("article content entry post story title".split())
FURNITURE_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist
    toolbar""".split())
MAIN_NAMES = frozenset(["articlebody", "article-body", "article-content", "entry-content", "post-content", "post-body", "story-body"])
#: Open elements that a start tag closes, and the elements that this does not pass.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"})}
SCOPE = frozenset(["table", "td", "th", "caption", "button", "object", "template", "html"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

OUTSIDE, MAIN, ARTICLE, FURNITURE, DOUBTFUL = range(5)


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def level_of(tag: str, text: str, level: int) -> int:
    """Level of an element opened inside one of ``level``; ``text`` holds its attributes."""
    if level == FURNITURE or level == DOUBTFUL:
        return DOUBTFUL if tag == "article" and level == FURNITURE else level
    if tag in FURNITURE_TAGS or tag == "header" and level == OUTSIDE:
        return FURNITURE
    if text and TELLING.search(text):
        given = attributes(text)
        name = f"{given.get('class', '')} {given.get('id', '')}"
        words = set(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()))
        odd = words & FURNITURE_NAMES
        if odd <= {"header"} and words & ARTICLE_NAMES:
            odd = set()
        whole = tag in ("html", "body", "main") or tag == "article" and not odd & {"comment", "comments", "reply", "related", "recommended"}
        if odd and not whole and tag not in HEADINGS:
            return FURNITURE
        style = given.get("style", "").replace(" ", "").lower()
        if ("hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
                or given.get("role", "").lower() in FURNITURE_ROLES):
            return FURNITURE
        if given.get("role", "").lower() == "main":
            level = max(level, MAIN)
        if {given.get("itemprop", "").lower(), *name.lower().split()} & MAIN_NAMES or given.get("role", "").lower() == "article":
            return ARTICLE
    return ARTICLE if tag == "article" else max(level, MAIN) if tag == "main" else level


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """Blocks of the page in order: (text, level, made of links alone)."""
    lines: list[tuple[str, int, bool]] = []
    stack: list[tuple[str, int]] = [("", OUTSIDE)]
    parts: dict[int, list[str]] = {}
    plain: set[int] = set()
    links = 0

    def flush() -> None:
        for level, found in parts.items():
            text = " ".join("".join(found).split())
            if text:
                lines.append((text, level, level not in plain))
        parts.clear()
        plain.clear()

    def add(text: str) -> None:
        if text:
            level = stack[-1][1]
            parts.setdefault(level, []).append(html.unescape(text) if "&" in text else text)
            if not links and not text.isspace():
                plain.add(level)

    def close(names: set[str] | frozenset[str], borders: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of these names, and all in it; not past a border."""
        nonlocal links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                links -= sum(name == "a" for name, _ in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in borders:
                return

    at = 0
    while m := TAG.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        block = tag in BLOCKS
        if block:
            flush()
        if m[1] or m[4]:
            close({tag}, SCOPE - {tag} if block else BLOCKS)
            continue
        if tag == "br":
            add(" ")
        if tag in VOID:
            continue
        if block:
            close({"p"}, SCOPE)
        if tag in CLOSES:
            close(*CLOSES[tag])
        stack.append((tag, level_of(tag, m[3] or "", stack[-1][1])))
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
    add(page[at:])
    flush()
    return lines


def shared(a: list, b: list) -> list[bool]:
    """Which places of ``a`` are in a longest common subsequence with ``b``.

    Rows of bits, one for each place of ``b``; every so many are kept and those between are made again on the
    way back, so memory is the square root of the rows times their length.
    """
    marks = [False] * len(a)
    first, end_a, end_b = 0, len(a), len(b)
    while first < min(end_a, end_b) and a[first] == b[first]:
        marks[first] = True
        first += 1
    while end_a > first and end_b > first and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
        marks[end_a] = True
    common = set(a[first:end_a]) & set(b[first:end_b])
    places = [i for i in range(first, end_a) if a[i] in common]
    other = [x for x in b[first:end_b] if x in common]
    if not places:
        return marks
    where: dict = {}
    for i, place in enumerate(places):
        where[a[place]] = where.get(a[place], 0) | 1 << i
    ones = (1 << len(places)) - 1

    def after(row: int, x) -> int:
        hit = row & where[x]
        return (row + hit | row - hit) & ones

    step = math.isqrt(len(other)) + 1
    kept, row = [ones], ones
    for j, x in enumerate(other, 1):
        row = after(row, x)
        if j % step == 0:
            kept.append(row)
    j, i, base, rows = len(other), len(places), -1, []
    while i and j:
        if j // step != base or (j - 1) // step != base:  # rows j - 1 and j are needed
            base = (j - 1) // step
            rows = [kept[base]]
            for x in other[base * step:min((base + 1) * step, len(other))]:
                rows.append(after(rows[-1], x))
        bit = i - 1
        if rows[j - base * step] >> bit & 1:
            i -= 1
        else:
            j -= 1
            if not j or rows[j - base * step] >> bit & 1:
                marks[places[bit]] = True
                i -= 1
    return marks


def main_text(lines: list[str], levels: list[int], link_lines: list[bool], common: list[bool]) -> str:
    """The lines that stay, by the rules at the top of this module."""
    top = max((x for x in levels if x in (OUTSIDE, MAIN, ARTICLE)), default=None)
    if top is None:
        return "\n".join(x for x, level in zip(lines, levels) if level == DOUBTFUL)
    stays = {MAIN: top >= MAIN, OUTSIDE: top == OUTSIDE, ARTICLE: True}
    kept = [x for x, level, link, also in zip(lines, levels, link_lines, common)
            if stays.get(level) and not (also and (link if level == top and level != OUTSIDE else True))]
    if not kept:
        kept = [x for x, level in zip(lines, levels) if level == top]
    return "\n".join(kept)


def nearest(path: str, before: tuple[str, list] | None, behind: tuple[str, list] | None) -> list:
    """Hashes of the neighbour with the longer common beginning of the path, then of the more similar length, then the one before."""
    def far(other: tuple[str, list]) -> tuple[int, int]:
        return -len(os.path.commonprefix([path, other[0]])), abs(len(path) - len(other[0]))

    found = [x for x in (before, behind) if x is not None]
    return min(found, key=far)[1] if found else []


def neighbours(versions: DataFrame) -> DataFrame:
    """For each (host, path): path and line hashes of the paths before and behind it on the same host."""
    per_path = versions.filter("host <> ''").groupBy("host", "path").agg(F.min("hashes").alias("hashes"))
    ranges = save_and_reread(per_path.repartitionByRange("host", "path").withColumn("pid", F.spark_partition_id()), "pages-paths")
    page = F.struct("host", "path", "hashes")
    ends = ranges.groupBy("pid").agg(F.min_by(page, F.struct("host", "path")).alias("first"), F.max_by(page, F.struct("host", "path")).alias("last"))
    by_pid = W.orderBy("pid")  # one row a range
    ends = ends.select(F.col("pid"), F.lag("last").over(by_pid).alias("before"), F.lead("first").over(by_pid).alias("behind"))
    guests = (ends.select("pid", F.explode(F.array("before", "behind")).alias("g")).filter("g is not null")
              .select("g.host", "g.path", "g.hashes", "pid", F.lit(True).alias("guest")))
    order = W.partitionBy("pid").orderBy("host", "path")
    side = lambda c: F.when(c["host"] == F.col("host"), F.struct(c["path"].alias("path"), c["hashes"].alias("hashes")))
    return (ranges.withColumn("guest", F.lit(False)).unionByName(guests)
            .withColumn("before", F.lag(page).over(order)).withColumn("behind", F.lead(page).over(order))
            .filter(~F.col("guest"))
            .select("host", "path", side(F.col("before")).alias("before"), side(F.col("behind")).alias("behind")))


#: What a page takes to its neighbours: its lines (compressed; a line holds no line break), a byte of level and link for each, and their hashes.
FIELDS = [("lines", "binary"), ("marks", "binary"), ("hashes", "binary")]


def packed_lines(lines: list[tuple[str, int, bool]]) -> bytes:
    """The lines that may stay; the others are empty."""
    inside = any(level in (MAIN, ARTICLE) for _, level, _ in lines)
    return zlib.compress("\n".join("" if level == FURNITURE or inside and level == OUTSIDE else t for t, level, _ in lines).encode(), 3)


def line_columns():
    def work(pages: list[bytes | None]) -> list:
        found = [page_lines(p.decode()) if p else [] for p in pages]
        return [[packed_lines(page) for page in found], [bytes(2 * level + link for _, level, link in page) for page in found],
                [b"".join(xxhash.xxh64_digest(t.encode()) for t, *_ in page) for page in found]]

    return work


def hash_column():
    def work(pages: list[bytes | None]) -> list:
        return [[b"".join(xxhash.xxh64_digest(t.encode()) for t, *_ in page_lines(p.decode())) if p else b"" for p in pages]]

    return work


def split_hashes(data: bytes | None) -> list[bytes]:
    return [data[i:i + 8] for i in range(0, len(data or b""), 8)]


def main_texts(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Text of the article of every page: columns ``text`` and ``n_chars`` (long) in place of the html.

    Character references are decoded (names of HTML 5, numbers), white space inside a
    block becomes one space, blocks are trimmed and joined by a line break in page order; nothing
    else is changed.  Lines are compared by 64-bit hashes.

    A null or empty page, or one without lines, gives an empty text.  A page without host in its URL
    (or a null URL) has no neighbour.  Pages of one host and path (whatever the query) count as versions of one
    page: the one with the least line hashes stands for it to its neighbours.  Equal rows
    give equal results, each its own row.  Unclosed and wrongly nested tags are closed as browsers do; very long pages are handled whole.  All other columns are kept; an input column named
    ``text`` or ``n_chars`` (in any case) gives way.  An empty table gives an empty table.
    """
    keep = [n for n in pages.columns if n != html_col and n.lower() not in ("text", "n_chars")]
    kept = [f"k{i}" for i in range(len(keep))]
    url = F.coalesce(col(url_col).cast("string"), F.lit(""))
    parts = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)", 1), F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    given = pages.select(F.lower(parts[0]).alias("host"), F.regexp_replace(parts[1], "/+$", "").alias("path"),
                         *[col(n).alias(k) for n, k in zip(keep, kept)], col(html_col).alias("html"))
    lined = append_columns(given, "html", line_columns, FIELDS, keep=["host", "path", *kept])
    hashed = append_columns(given.select("host", "path", "html"), "html", hash_column, [("hashes", "binary")], keep=["host", "path"])
    joined = lined.join(neighbours(hashed), ["host", "path"], "left")
    schema = T.StructType([joined.schema[k] for k in kept] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for path, lines, marks, hashes, before, behind in zip(*(batch.column(n).to_pylist() for n in (
                    "path", "lines", "marks", "hashes", "before", "behind"))):
                sides = [(x["path"], split_hashes(x["hashes"])) if x else None for x in (before, behind)]
                common = shared(split_hashes(hashes), nearest(path, *sides))
                given = zlib.decompress(lines).decode().split("\n") if marks else []
                texts.append(main_text(given, [m >> 1 for m in marks], [bool(m & 1) for m in marks], common))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in kept] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*kept, "text", "n_chars"])

    return map_batches(joined, run, schema).toDF(*keep, "text", "n_chars")
