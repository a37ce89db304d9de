import html
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import elements as E
from rivulet.plans.books import book_links, book_records


def random_page(r, depth=0):
    """(page, nodes): a balanced page and its nodes (tag, classes, id, path of nodes above, place, text) written down while it is made."""
    nodes = []

    def grow(above, depth):
        out, text, children = "", "", []
        for _ in range(r.randrange(4)):
            if depth > 4 or r.random() < 0.4:
                word = r.choice(["a", "b & c", "<x>", " ", "é"])
                out, text = out + html.escape(word), text + word
            else:
                tag, classes, ident = r.choice(["div", "p2", "span", "b"]), set(r.sample(["x", "y", "z"], r.randrange(3))), r.choice(["", "", "one"])
                node = {"tag": tag, "classes": classes, "id": ident, "above": above, "before": list(children)}
                nodes.append(node)
                children.append(node)
                inner, inside = grow([*above, node], depth + 1)
                node["text"] = inside
                quote = r.choice("'\"")
                attrs = (f" class={quote}{' '.join(sorted(classes))}{quote}" if classes else "") + (f" id={ident}" if ident else "")
                out, text = out + f"<{tag}{attrs}>{inner}</{tag}>", text + inside
        return out, text

    return grow([], 0)[0], nodes


def matches(node, steps):
    """Right to left over the written-down structure."""
    (combinator, tag, classes, ident), rest = steps[-1], steps[:-1]
    if not ((not tag or node["tag"] == tag) and classes <= node["classes"] and (not ident or node["id"] == ident)):
        return False
    if not rest:
        return True
    pool = {" ": node["above"], ">": node["above"][-1:], "~": node["before"], "+": node["before"][-1:]}[combinator]
    return any(matches(x, rest) for x in pool)


SELECTORS = {"div": [(" ", "div", set(), "")], ".x": [(" ", "", {"x"}, "")], "div.x.y": [(" ", "div", {"x", "y"}, "")],
             "div span": [(" ", "div", set(), ""), (" ", "span", set(), "")], "div > div": [(" ", "div", set(), ""), (">", "div", set(), "")],
             "#one ~ b": [(" ", "", set(), "one"), ("~", "b", set(), "")], "span + div .z": [(" ", "span", set(), ""), ("+", "div", set(), ""), (" ", "", {"z"}, "")],
             "div div div": [(" ", "div", set(), "")] * 3}


def test_selectors_equal_brute_force():
    r = random.Random(1)
    hits = 0
    for _ in range(400):
        page, nodes = random_page(r)
        root = E.tree(page)
        for selector, steps in SELECTORS.items():
            want = [n["text"].strip() for n in nodes if matches(n, steps)]
            assert [e.text() for e in E.found(root, E.parsed(selector))] == want, (selector, page)
            hits += len(want)
    assert hits > 400


def test_unclosed_and_odd_markup():
    texts = lambda page, selector: [e.text() for e in E.found(E.tree(page), E.parsed(selector))]
    assert texts("<div><div>in</div> tail</div>", "div") == ["in tail", "in"]
    assert texts("<ul><li>1<li>2<ul><li>2a</ul><li>3</ul>", "ul > li") == ["1", "22a", "2a", "3"]
    assert texts("<table><tr><th>a<td>b<tr><th>c<td>d</table>", "td") == ["b", "d"]
    assert texts("<div>x<br>y<img src=i></b></div>z", "div") == ["xy"]
    assert texts("<p>never closed", "p") == ["never closed"] and texts("", "p") == [] and texts("a &amp", "p") == []
    assert texts("<div><script>var x = '<p>no</p>'</script><!-- <p>no</p> --><p>yes</p></div>", "p") == ["yes"]
    with pytest.raises(ValueError):
        E.parsed("a:hover")


def test_select_on_a_frame(spark):
    page = "<div id=d class='a b'><div>in</div> tail</div><a href='x&amp;y'>1</a><a>2</a><table><tr><th>k</th><td>v</td><td>w</td></tr><tr><th>k</th><td>u</td></tr></table>"
    df = spark.createDataFrame([(page,), ("",), (None,)], "html string")
    got = [r["s"] for r in df.select(E.select(F.col("html"), {"text": ("div.a", "text"), "href": ("a", "@href")}, tables="t").alias("s")).collect()]
    assert (got[0]["text"], got[0]["href"], got[0]["t"]) == (["in tail"], ["x&y", None], {"k": "v"})
    assert (got[1]["text"], got[1]["t"]) == ([], {}) and (got[2]["text"], got[2]["t"]) == (None, None)


def test_links_stay_within_their_article(spark):
    """An article without a link takes none of another's, nor an advertisement's behind it."""
    page = ("<article class='product_pod'><h3>sold out</h3></article><a href='../../ad'>ad</a>"
            "<article class='big product_pod'><div><h3><b><a title=t href=\"../../b/1\">x</a></b></h3></div></article>"
            "<article class='product_pods'><h3><a href='no'>n</a></h3></article><article class=product_pod><h3><a>none</a></h3></article>")
    got = [r.url for r in book_links(spark.createDataFrame([(page,), (None,)], "html string")).collect()]
    assert got == ["https://books.toscrape.com/catalogue/b/1"]


def test_records_with_nested_blocks(spark):
    page = ("<div class='product_main'><div><div>price</div></div><h1>Title <i>x</i></h1></div>"
            "<div id='product_description'><div>inner</div></div><span>s</span><p>Real <b>text</b></p><p>other</p>")
    good, bad = book_records(spark.createDataFrame([("u", page), ("v", None)], "url string, html string"))
    row = good.first()
    assert (row.titre, row.description, row.categorie) == ("Title x", "Real text", "Books")
    assert [(r.url, r.reject_reason) for r in bad.collect()] == [("v", "missing input")]


def test_pages_of_one_file_are_parsed_once_and_by_all_cores(spark, tmp_dir):
    from rivulet.plans.books import book_links, book_records
    path = f"{tmp_dir}/pages"
    page = F.when(F.col("id") % 2 == 0, "<div class='product_main'><h1>t</h1></div><article class=product_pod><h3><a href=x>").otherwise("<p>")
    spark.range(200).select(F.col("id").cast("string").alias("url"), page.alias("html")).coalesce(1).write.parquet(path)
    good, bad = book_records(spark.read.parquet(path))
    for df, rows in ((good, 100), (bad, 100), (book_links(spark.read.parquet(path)), 100)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        per_task = df.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per_task) == rows and len(per_task) > 4
