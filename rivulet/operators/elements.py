"""Elements of HTML pages by selectors, nested ones included.

Regexes cannot balance nested elements, so pages pass once through the standard library's
parser, in Arrow batches on the executors: a stack of open elements gives each
page a small tree, and all selectors of a query are answered from it.  One pass serves
all fields of a page.

Selectors: ``tag``, ``.class``, ``#id`` and their compounds (``div.a.b#c``), joined by a space (a
descendant), ``>`` (a child), ``~`` (a later sibling) or ``+`` (the next sibling).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements without an end tag, and start tags that end an open element of the same row or list.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


class Element:
    """An element; ``inner`` holds its texts and elements in order."""

    def __init__(self, tag: str, attrs: Mapping[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.inner = tag, attrs, parent, []

    def children(self) -> list[Element]:
        return [x for x in self.inner if isinstance(x, Element)]

    def descendants(self) -> Iterator[Element]:
        todo = self.children()[::-1]
        while todo:
            e = todo.pop()
            yield e
            todo += e.children()[::-1]

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in ("script", "style"):
                todo += x.inner[::-1]
        return "".join(out).strip()


class Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.end(ENDS.get(tag, set()), HOLDS.get(tag, set()))
        e = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)  # the first of repeated attributes counts
        self.at.inner.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        self.end({tag}, set())

    def end(self, names: set[str], borders: set[str]) -> None:
        """Close the innermost open element of these names, unless a border is open inside it."""
        e = self.at
        while e.parent is not None and e.tag not in borders:
            if e.tag in names:
                self.at = e.parent
                return
            e = e.parent

    def handle_data(self, data: str) -> None:
        self.at.inner.append(data)

    def updatepos(self, i: int, j: int) -> int:
        """Lines and columns are not counted: nobody asks for them."""
        return j


def tree(page: str) -> Element:
    builder = Builder()
    builder.feed(page)
    HTMLParser.close(builder)  # hands over text that waits for more
    return builder.root


Step = tuple[str, str, frozenset[str], str]


def parsed(selector: str) -> list[Step]:
    """(combinator, tag, classes, id) of each compound."""
    steps, combinator = [], " "
    for token in re.findall(r"[>~+]|[^\s>~+]+", selector):
        if token in ">~+":
            combinator = token
            continue
        if not re.fullmatch(r"(?:[\w*-]+)?(?:[.#][\w-]+)*", token):
            raise ValueError(f"selector {selector!r} is not understood at {token!r}")
        tag = re.match(r"[\w*-]*", token)[0].lower()
        names = re.findall(r"([.#])([\w-]+)", token)
        steps.append((combinator, "" if tag == "*" else tag, frozenset(n for k, n in names if k == "."), next((n for k, n in names if k == "#"), "")))
        combinator = " "
    return steps


def fits(e: Element, step: Step) -> bool:
    _, tag, classes, identity = step
    return ((not tag or e.tag == tag) and (not identity or e.attrs.get("id") == identity)
            and (not classes or classes <= set(e.attrs.get("class", "").split())))


def chain_fits(e: Element, steps: list[Step]) -> bool:
    """Whether the last step fits the element and the others fit around it."""
    if not fits(e, steps[-1]):
        return False
    if len(steps) == 1:
        return True
    around = []
    if steps[-1][0] == ">":
        around = [e.parent]
    elif steps[-1][0] in "~+":
        before = e.parent.children()
        before = before[:next(i for i, x in enumerate(before) if x is e)]
        around = before[::-1][:1] if steps[-1][0] == "+" else before[::-1]
    else:
        up = e.parent
        while up is not None:
            around.append(up)
            up = up.parent
    return any(x is not None and x.parent is not None and chain_fits(x, steps[:-1]) for x in around)


def by_tag(root: Element) -> dict[str, list[Element]]:
    """All elements in page order, under "" and under their tags."""
    out: dict[str, list[Element]] = {"": list(root.descendants())}
    for e in out[""]:
        out.setdefault(e.tag, []).append(e)
    return out


def found_among(elements: Mapping[str, list[Element]], steps: list[Step]) -> list[Element]:
    """The elements (of :func:`by_tag`) that a selector finds; those of its last compound's tag alone are looked at."""
    return [e for e in elements.get(steps[-1][1], ()) if chain_fits(e, steps)]


def found(root: Element, steps: list[Step]) -> list[Element]:
    return found_among(by_tag(root), steps)


def value_of(e: Element, what: str) -> str | None:
    return e.text() if what == "text" else e.attrs.get(what.removeprefix("@"))


def select(html: Column, fields: Mapping[str, tuple[str, str]], tables: str | None = None) -> Column:
    """A struct of arrays, one for each field: what the elements of its selector hold, in page order.

    ``fields`` maps a name to (selector, ``"text"`` or ``"@attribute"``).  Texts are stripped at both
    ends; character references are decoded; scripts and styles have no text; an element
    without the attribute gives a null.  No element gives an empty array, a null page gives nulls.  ``tables``
    names one more field: a map of each ``th``'s text to its following ``td``'s, the first of a name counting.
    """
    wanted = [(name, parsed(selector), what) for name, (selector, what) in fields.items()]
    kind = ", ".join(f"`{name}`: array<string>" for name, *_ in wanted) + (f", `{tables}`: map<string, string>" if tables else "")

    @F.arrow_udf(f"struct<{kind}>")
    def answer(pages: pa.Array) -> pa.Array:
        columns: list[list] = [[] for _ in range(len(wanted) + bool(tables))]
        for page in pages.to_pylist():
            elements = None if page is None else by_tag(tree(page))
            for out, (_, steps, what) in zip(columns, wanted):
                out.append(None if elements is None else [value_of(e, what) for e in found_among(elements, steps)])
            if tables:
                columns[-1].append(None if elements is None else list(table_values(elements).items()))
        types = [pa.list_(pa.string())] * len(wanted) + [pa.map_(pa.string(), pa.string())] * bool(tables)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[n for n, *_ in wanted] + [tables] * bool(tables))

    # called so, a filter on the result does not bring a second parse of each page: Spark copies no such call below a projection
    return answer.asNondeterministic()(html)


def table_values(elements: Mapping[str, list[Element]]) -> dict[str, str]:
    """Text of each ``th`` -> text of the next ``td`` behind it in its row."""
    out: dict[str, str] = {}
    for e in elements.get("th", ()):
        row = e.parent.children()
        after = row[next(i for i, x in enumerate(row) if x is e) + 1:]
        cell = next((x for x in after if x.tag == "td"), None)
        if cell is not None:
            out.setdefault(e.text(), cell.text())
    return out


def spread(pages: DataFrame) -> DataFrame:
    """The pages dealt evenly over the cluster's cores, four tasks a core.

    Parsing costs far more than reading: a small, well compressed file is read by one task, which would parse all its pages.
    """
    tasks = 4 * pages.sparkSession.sparkContext.defaultParallelism
    return pages.withColumn("_page", F.monotonically_increasing_id()).repartition(tasks, "_page").drop("_page")
