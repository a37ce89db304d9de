"""Fields and links out of raw HTML pages, with built-in regex expressions.

Pages are a string column; every function returns a ``Column`` so a whole
page table is parsed by executor tasks in codegen, without a Python parser.
Script, style and comment blocks are removed first so that markup-like text
inside them (e.g. ``var t = "</p>"``) cannot end a match early.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.clean import strip_whitespace

_DECOYS = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_decoys(html) -> Column:
    return F.regexp_replace(_c(html), _DECOYS, "")



def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), 0)


_ENTITY = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
# The standard library's HTML 5 references, with ';' and (for some) without.
_NAMES = json.dumps(html5)
_WITHOUT_SEMICOLON = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
# Numbers 128-159 mean the Windows-1252 characters, where there is one.
_WINDOWS = json.dumps({str(n): c for n in range(0x80, 0xA0) for c in [bytes([n]).decode("cp1252", "ignore")] if c})


def _char(code: Column) -> Column:
    """The character of a code point; '' for controls and non-characters, U+FFFD for invalid ones."""
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    invalid = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    silent = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
              | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    windows = F.element_at(F.from_json(F.lit(_WINDOWS), "map<string,string>"), code.cast("string"))
    return F.when(invalid, "\ufffd").when(silent, "").otherwise(F.coalesce(windows, text))


def _decode_entity(e: Column) -> Column:
    """What follows '&' of a reference -> its text; an unknown name stays as written.

    A name without ';' may be the beginning of a longer word ('&eacutex'): the
    longest reference that needs no ';' counts, as browsers do.
    """
    digits = F.regexp_replace(e, "^#[xX]?0*|;$", "")
    number = F.when(e.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
    code = F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(F.coalesce(number, F.lit(0))).cast("long")
    names = F.from_json(F.lit(_NAMES), "map<string,string>")
    longer = bind(F.regexp_extract(e, f"^({_WITHOUT_SEMICOLON})", 1), lambda begin: F.when(
        begin != "", F.concat(F.element_at(names, begin), F.substring(e, F.length(begin) + 1, F.length(e)))))
    common = F.when(e == "amp;", "&").when(e == "lt;", "<").when(e == "gt;", ">").when(e == "quot;", '"').when(e == "nbsp;", "\u00a0")
    return (F.when(e.startswith("#"), bind(code, _char))
             .otherwise(F.coalesce(common, F.element_at(names, e), longer, F.concat(F.lit("&"), e))))


def unescape_html(text) -> Column:
    """Decode character references: named (HTML 5 table), decimal and hex, of any length.

    The text is split around the references, each reference is decoded and
    the pieces are joined again (built-in expressions only); text without
    '&' is returned as is.
    """
    def decode(t: Column) -> Column:
        refs = F.transform(F.regexp_extract_all(t, F.lit(_ENTITY), 1), _decode_entity)
        pieces = F.split(t, _ENTITY, -1)
        joined = F.array_join(F.zip_with(pieces, F.concat(refs, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
        return F.when(t.contains("&"), joined).otherwise(t)
    return bind(_c(text), decode)


def text_of(fragment) -> Column:
    """Visible text of an HTML fragment: tags dropped, character references
    decoded, whitespace stripped (as ``str.strip``).

    An empty element gives ''; a null fragment (absent element) gives null.
    """
    t = F.regexp_replace(_c(fragment), r"<[^>]*>", "")
    return strip_whitespace(unescape_html(t))


def element_inner(html, tag: str, attrs: str = "", occurrence_in: str | None = None) -> Column:
    """Inner HTML of the first ``<tag ...attrs...>`` element ('' when absent).

    ``attrs`` is a regex matched inside the opening tag (e.g. ``class="x"``);
    ``occurrence_in`` restricts the search to the inner HTML of another tag.
    Nested elements of the same tag are not balanced (first closing tag wins).
    """
    src = _c(html) if occurrence_in is None else element_inner(html, occurrence_in)
    attr = f"[^>]*{attrs}" if attrs else ""
    pattern = rf"(?is)<{tag}\b{attr}[^>]*>(.*?)</{tag}\s*>"
    return F.regexp_extract(src, pattern, 1)


def element_text(html, tag: str, attrs: str = "", within: str | None = None) -> Column:
    """Text of the first matching element: null when there is no such element,
    '' when it is empty."""
    src = _c(html) if within is None else element_inner(html, within)
    return F.when(has_element(src, tag, attrs), text_of(element_inner(src, tag, attrs)))


def has_element(html, tag: str, attrs: str = "") -> Column:
    attr = f"[^>]*{attrs}" if attrs else ""
    return _c(html).rlike(rf"(?is)<{tag}\b{attr}[^>]*>")


def list_items(fragment) -> Column:
    """Inner HTML of each ``<li>`` of a fragment, in order."""
    return F.regexp_extract_all(_c(fragment), F.lit(r"(?is)<li\b[^>]*>(.*?)</li\s*>"), 1)


def nth_item_text(fragment, n: int, default: str | None = None) -> Column:
    """Text of the n-th (0-based) list item; ``default`` when there are fewer items."""
    item = text_of(F.get(list_items(fragment), n))
    return item if default is None else F.coalesce(item, F.lit(default))


# An attribute's value with its quotes, if any.
_VALUE = r"(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"


def attribute_value(raw: Column) -> Column:
    """A matched attribute value: quotes taken off, character references decoded."""
    return unescape_html(F.regexp_replace(raw, r"^[\"']|[\"']$", ""))


def class_attr(name: str) -> str:
    """Regex of a class attribute that holds ``name``, in any quoting (for ``attrs`` arguments)."""
    return rf"""\bclass\s*=\s*(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>]))"""


def link_hrefs(fragment) -> Column:
    """``href`` of every ``<a>`` of a fragment, in order; double-quoted, single-quoted or bare."""
    raw = F.regexp_extract_all(_c(fragment), F.lit(r"(?is)<a\b[^>]*?\shref\s*=\s*" + _VALUE), 1)
    return F.transform(raw, attribute_value)


def absolute_url(href, base: str, strip_prefix: str = r"^(\.\./)+") -> Column:
    """Relative link -> absolute: leading ``../`` runs removed, base prefixed.

    Links that already carry a scheme are kept.
    """
    h = _c(href)
    rel = F.regexp_replace(F.regexp_replace(h, strip_prefix, ""), r"^/+", "")
    return F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), h).otherwise(F.concat(F.lit(base), rel))


def absolute_links(fragment, base: str) -> Column:
    return F.transform(link_hrefs(fragment), lambda h: absolute_url(h, base))


_ROW = r"(?is)<tr\b[^>]*>\s*<th\b[^>]*>.*?</th\s*>\s*<td\b[^>]*>.*?</td\s*>"


def table_pairs(html) -> Column:
    """Map of header cell to value cell text (``th`` -> next ``td``) over all table rows; a header's first row counts."""
    rows = F.regexp_extract_all(_c(html), F.lit(_ROW), 0)
    pairs = F.transform(rows, lambda r: F.struct(
        text_of(F.regexp_extract(r, r"(?is)<th\b[^>]*>(.*?)</th\s*>", 1)).alias("head"),
        text_of(F.regexp_extract(r, r"(?is)<td\b[^>]*>(.*?)</td\s*>", 1)).alias("cell")))
    return bind(pairs, lambda ps: F.map_from_entries(F.filter(
        ps, lambda p, i: ~F.exists(F.slice(ps, F.lit(1), i), lambda q: q["head"] == p["head"]))))


def table_lookup(html, label: str) -> Column:
    """Value cell of the row whose header cell reads ``label``; an absent label gives null.

    For several labels of one page, take :func:`table_pairs` once.
    """
    return F.try_element_at(table_pairs(html), F.lit(label))


def relabel(value, pattern: str = r"^/(.*)$", group: int = 1) -> Column:
    """Relabel by a fully matching regex (e.g. container '/web' -> 'web'); no match -> ''."""
    return F.regexp_extract(_c(value), pattern, group)


def with_validity(df: DataFrame, valid: Column, reason: Column,
                  status_col: str = "status", reason_col: str = "reject_reason") -> DataFrame:
    """One pass: ``status`` ('ok' / 'rejected') and the reject reason (null when ok).

    A null validity (e.g. a null page) counts as invalid, with the reason
    "missing input" when ``reason`` itself is null.
    """
    ok = F.coalesce(valid, F.lit(False))
    return df.withColumns({status_col: F.when(ok, F.lit("ok")).otherwise(F.lit("rejected")),
                           reason_col: F.when(~ok, F.coalesce(reason, F.lit("missing input")))})


def split_valid(df: DataFrame, valid: Column, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Per-record error isolation: ``(good, rejected)``; rejected rows carry a reason.

    Both are filters over the same input, so bad records never fail the run.
    When both sides are consumed by one query, :func:`with_validity` does it
    in a single pass.
    """
    ok = F.coalesce(valid, F.lit(False))          # a null check is a failed check
    good = df.filter(ok)
    rejected = df.filter(~ok).withColumn("reject_reason", F.coalesce(reason, F.lit("missing input")))
    return good, rejected
