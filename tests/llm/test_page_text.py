import html
import random
import re

import duckdb
import pytest

from rivulet.llm import page_text as P

from ..conftest import SF_SMALL


def text_of(page, neighbour=""):
    lines = P.page_lines(page)
    common = P.shared([t for t, *_ in lines], [t for t, *_ in P.page_lines(neighbour)])
    return P.main_text([t for t, *_ in lines], [x for _, x, _ in lines], [x for *_, x in lines], common)


def lcs_length(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_shared_is_a_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(3000):
        a = [r.randrange(r.choice([1, 3, 8])) for _ in range(r.randrange(16))]
        b = [r.randrange(4) for _ in range(r.randrange(16))]
        kept = [x for x, m in zip(a, P.shared(a, b)) if m]
        rest = iter(b)
        assert len(kept) == lcs_length(a, b) and all(x in rest for x in kept)


def test_shared_on_long_pages():
    r = random.Random(2)
    a = [r.randrange(900) for _ in range(6000)]
    b = a[:1000] + [r.randrange(900) for _ in range(4000)] + a[1500:3000]
    assert sum(P.shared(a, b)) >= 2500


@pytest.mark.parametrize("page, text", [
    ("", ""),
    ("plain &lt;words&gt;", "plain <words>"),
    ("<article><h1> A&nbsp;&amp\n b </h1><p>one<p>two <b>bold</b><i>er</i><br>end</article>", "A & b\none\ntwo bolder end"),
    ("<nav>menu</nav><article><p>x<div class='ad'>buy</div>y</article><footer>z</footer>", "x\ny"),
    ("<header>site</header><main><h1>t</h1><aside>side</aside><article><p>x</p><footer>tags</footer></article></main>", "t\nx"),
    ("<article><header><h1>T</h1></header><p>x<script>var a='</p><p>no';</script>y<style>p{}</style></article>", "T\nxy"),
    ("<article>a<!-- <p>no</p> -->b<!-- never closed </article>", "ab"),
    ("<body><form><p>search</p></form><p>kept</p><section class='comments'><article><p>reader</p></article></section>", "kept"),
    ("<article><p>x</p><div id='cookie-notice'>c</div><ul><li>1<li>2</ul><table><tr><td>a<td>b</table></article>", "x\n1\n2\na\nb"),
    ("<article><p>1 < 2 & 3 > 2 &#65;&#x42;&hellip;</p></article>", "1 < 2 & 3 > 2 AB…"),
    ("<article><p title='a > b'>x</p><p hidden>no</p><p style='display: none'>no</p><div role=navigation>no</div></article>", "x"),
    ("<div><div><article><p>x</b></span></p></div></article><p>out</p>", "x"),
    ("<div class='ad'><article><p>only text</p></article>", "only text"),
    ("<ARTICLE><P>upper</P><TEXTAREA><p>no</TEXTAREA></ARTICLE>", "upper"),
    ("<p>a<span class='share'>no</span>b", "ab"),
    ("<article><p>cut off <b>here", "cut off here"),
    ("<a <b <a x='", "<a <b <a x='"),
])
def test_markup(page, text):
    assert text_of(page) == text


SITE = "<div>Site name</div><p>Accept our terms</p>{}<p>All rights reserved</p>"


def test_shared_lines_go_where_markup_is_silent():
    a, b = SITE.format("<p>first text</p><p>same passage</p>"), SITE.format("<p>second text</p>")
    assert text_of(a, b) == "first text\nsame passage"
    assert text_of(a, a) == text_of(a)  # a copy tells nothing


def test_shared_article_lines_stay_unless_links_alone():
    page = "<article><p>{}</p><p>common passage</p><p><a href=x>Share this</a></p></article>"
    assert text_of(page.format("one"), page.format("two")) == "one\ncommon passage"
    assert text_of(page.format("one"), "") == "one\ncommon passage\nShare this"
    assert text_of("<p>out</p><main><p>top</p><article><p>x</p></article><p>own</p></main>", "<p>top</p>") == "x\nown"


SCHEMA = "page_id bigint, url string, html string, Text string, host string, `key.dot` string"


def run(spark, rows):
    out = P.main_texts(spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA))
    assert out.columns == ["page_id", "url", "host", "key.dot", "text", "n_chars"]
    return [tuple(r) for r in out.select("page_id", "url", "text", "n_chars").collect()]


def brute(rows):
    """Neighbours by sorting all paths of a host."""
    paths = {}
    for _, url, page in rows:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)([^?#]*)", url or "")
        if m:
            hashes = [P.xxhash.xxh64_digest(t.encode()) for t, *_ in P.page_lines(page or "")]
            paths.setdefault(m[1].lower(), {}).setdefault(m[2].rstrip("/"), []).append((b"".join(hashes), hashes))
    out = []
    for i, url, page in rows:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)([^?#]*)", url or "")
        other = []
        if m:
            host, path = paths[m[1].lower()], m[2].rstrip("/")
            order = sorted(host, key=str.encode)
            at = order.index(path)
            sides = [(order[k], min(host[order[k]])[1]) if 0 <= k < len(order) else None for k in (at - 1, at + 1)]
            other = P.nearest(path, *sides)
        lines = P.page_lines(page or "")
        common = P.shared([P.xxhash.xxh64_digest(t.encode()) for t, *_ in lines], other)
        text = P.main_text([t for t, *_ in lines], [x for _, x, _ in lines], [x for *_, x in lines], common)
        out.append((i, url, text, len(text)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    r = random.Random(3)
    rows = []
    for k in range(150):
        host = r.choice(["a.com"] * 3 + ["b.org", "C.net"])
        url = f"http://{host}/{r.choice(['x', 'y'])}/{r.randrange(40)}{r.choice(['', '/', '?q=1', '#top'])}"
        body = "".join(f"<p>{r.choice(['own', 'line', 'text'])} {r.randrange(60)}</p>" for _ in range(r.randrange(5)))
        rows.append((k, url, f"<div>{host} news</div><nav>n</nav>{body}<div>legal of {host}</div>"))
    rows += [(200, None, "<p>x</p>"), (201, "", None), (202, "http://a.com/x/1", None), (203, "http://a.com/x/1", ""), (204, "no url", "<p>y</p>"),
             (None, "http://lone.example/", "<p>z</p>"), (205, "http://b.org/" + "seg/" * 400, "<p>" + "long " * 50_000 + "</p>")]
    rows += rows[:3] * 2
    assert sorted(run(spark, rows), key=repr) == brute(rows)


def test_results_do_not_depend_on_ranges(spark):
    rows = [(k, f"http://h.com/p/{k:03}", f"<div>site</div><p>text {k // 2}</p>") for k in range(60)]
    want = brute(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            assert sorted(run(spark, rows), key=repr) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty(spark):
    assert run(spark, []) == []


def test_articles_of_the_tables(query_frame):
    """Every page's article equals a plain cut between the article tags (menus, adverts and footers are outside there)."""
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF_SMALL}/pages.parquet'").fetchall())
    got = query_frame("op11_html_text").collect()
    assert len(got) == len(pages)
    for row in got:
        blocks = re.split(r"</?(?:p|h1)>", re.search("<article>(.*?)</article>", pages[row["page_id"]], re.DOTALL)[1])
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert row["text"] == "\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])
