import json

from pyspark.sql import functions as F

from rivulet.operators import html as H
from rivulet.operators.flatten import flatten_countries, flatten_observations, flatten_rates, json_field


def test_flatten_countries_edges(spark):
    payload = json.dumps([
        {"name": {"common": "Kenya", "official": "Republic of Kenya"}, "capital": ["Nairobi"], "region": "Africa",
         "subregion": "Eastern Africa", "cca2": "KE", "cca3": "KEN", "population": 53771300, "area": 580367.0,
         "languages": {"eng": "English", "swa": "Swahili"},
         "currencies": {"KES": {"name": "Kenyan shilling"}}},
        {"name": {"common": "Nowhere"}, "capital": [], "cca3": None, "languages": {}, "currencies": {}},
        {"name": {"common": "Twocoins"}, "cca3": "TWO", "currencies": {"USD": {"name": "US dollar"}, "EUR": {"name": "Euro"}}},
    ])
    rows = {r.name: r for r in flatten_countries(spark.createDataFrame([(payload,)], "payload string")).collect()}
    k = rows["Kenya"]
    assert (k.official_name, k.capital, k.languages, k.currencies, k.currency_codes, k.iso2, k.iso3) == (
        "Republic of Kenya", "Nairobi", "English, Swahili", "Kenyan shilling", "KES", "KE", "KEN")
    n = rows["Nowhere"]
    assert (n.capital, n.languages, n.currencies, n.currency_codes, n.official_name) == (None, None, None, None, None)
    assert rows["Twocoins"].currency_codes == "USD, EUR" and rows["Twocoins"].currencies == "US dollar, Euro"


def test_flatten_observations_drops_null_values(spark):
    page = json.dumps([{"page": 1, "pages": 2}, [
        {"indicator": {"id": "SP.POP.TOTL"}, "country": {"id": "KE", "value": "Kenya"}, "date": "2022", "value": 5.0},
        {"indicator": {"id": "SP.POP.TOTL"}, "country": {"id": "KE", "value": "Kenya"}, "date": "2021", "value": None},
        {"indicator": {"id": "SP.POP.TOTL"}, "country": {"id": "NG", "value": "Nigeria"}, "date": "bad", "value": 7.0},
    ]])
    empty = json.dumps([{"page": 2, "pages": 2}, None])
    from pyspark.sql import Observation
    obs = Observation("pages")
    got = sorted(tuple(r) for r in flatten_observations(
        spark.createDataFrame([(page,), (empty,)], "payload string"), observation=obs).collect())
    assert got == [("SP.POP.TOTL", "KE", "Kenya", 2022, 5.0), ("SP.POP.TOTL", "NG", "Nigeria", None, 7.0)]
    assert obs.get == {"observations": 3, "dropped_null_value": 1, "bad_year": 1}


def test_flatten_rates_whitelist_and_empty(spark):
    p1 = json.dumps({"base": "GBP", "date": "2024-01-31", "rates": {"USD": 1.27, "JPY": 187.0, "EUR": 1.17}})
    p2 = json.dumps({"base": "GBP", "date": "2024-02-01", "rates": {}})
    out = flatten_rates(spark.createDataFrame([(p1,), (p2,)], "payload string")).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.USD, r.EUR, r.ZAR, r.base, r.date) == (1.27, 1.17, None, "GBP", "2024-01-31")
    assert "JPY" not in r.asDict()


def test_json_field(spark):
    df = spark.createDataFrame([('{"k": 87}',), ("not json",), (None,)], "props string")
    assert [r[0] for r in df.select(json_field("props", "$.k", "int")).collect()] == [87, None, None]


PAGE = """<html lang="en"><head><title>A &amp; B</title><script>var t = "</p><h1>fake</h1>";</script></head>
<body><ul class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/b">Books</a></li><li><a href="/p">Poetry</a></li><li>X</li></ul>
<!-- <div class="product_main"><h1>commented</h1></div> -->
<div class="product_main"><h1>Real &lt;Title&gt;</h1></div>
<div id="product_description"></div><p>Nice book.</p>
<table><tr><th>UPC</th><td> abc123 </td></tr><tr><th>Price (incl. tax)</th><td>£51.77</td></tr>
<tr><th>UPC</th><td>dup</td></tr></table>
<article class="product_pod"><h3><a href="../../some-book_1/index.html" title="x">Some</a></h3></article>
<article class="product_pod"><h3><a href="catalogue/other_2/index.html">Other</a></h3></article>
</body></html>"""


def test_html_fields(spark):
    df = spark.createDataFrame([(PAGE,), ("<html><body><ul class=\"breadcrumb\"><li>Home</li></ul></body></html>",)],
                               "html string").withColumn("h", H.strip_decoys("html"))
    r = df.select(
        H.element_text("h", "title").alias("title"),
        H.element_text("h", "h1", within="div").alias("h1"),
        H.text_of(H.element_inner("h", "div", 'class="product_main"')).alias("main"),
        H.table_lookup("h", "UPC").alias("upc"),
        H.table_lookup("h", "Price (incl. tax)").alias("price"),
        H.table_lookup("h", "Availability").alias("avail"),
        H.nth_item_text(H.element_inner("h", "ul", 'class="breadcrumb"'), 2, "Books").alias("cat"),
        H.has_element("h", "div", 'class="product_main"').alias("valid"),
    ).collect()
    a, b = r
    assert a.title == "A & B" and a.main == "Real <Title>"
    assert (a.upc, a.price, a.avail, a.cat, a.valid) == ("abc123", "£51.77", None, "Poetry", True)
    assert (b.cat, b.valid, b.upc) == ("Books", False, None)


def test_links_and_absolute_urls(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    links = df.select(F.explode(H.absolute_links(H.strip_decoys("html"), "https://books.example/catalogue/"))).collect()
    got = [r[0] for r in links]
    assert "https://books.example/catalogue/some-book_1/index.html" in got
    assert "https://books.example/catalogue/catalogue/other_2/index.html" in got
    assert df.select(H.relabel(F.lit("/web")).alias("x")).first().x == "web"


def test_split_valid(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "id int, ok boolean")
    tagged = {r.id: (r.status, r.reject_reason) for r in H.with_validity(df, F.col("ok"), F.lit("broken")).collect()}
    assert tagged == {1: ("ok", None), 2: ("rejected", "broken")}
    good, bad = H.split_valid(df, F.col("ok"), F.lit("broken"))
    assert [r.id for r in good.collect()] == [1]
    assert [(r.id, r.reject_reason) for r in bad.collect()] == [(2, "broken")]


def test_absent_vs_empty_elements(spark):
    df = spark.createDataFrame([("<div class='x'><h1>  </h1></div>",), ("<div class='x'></div>",)], "h string")
    got = [r[0] for r in df.select(H.element_text("h", "h1")).collect()]
    assert got == ["", None]



def test_null_pages_are_rejected_not_lost(spark):
    from rivulet.plans.books import book_records
    pages = spark.createDataFrame([("u1", None), ("u2", "<html></html>")], "url string, html string")
    good, bad = book_records(pages)
    assert good.count() == 0 and sorted(r.url for r in bad.collect()) == ["u1", "u2"]
    df = spark.createDataFrame([(1, None)], "id int, ok boolean")
    r = H.with_validity(df, F.col("ok"), F.lit(None).cast("string")).first()
    assert (r.status, r.reject_reason) == ("rejected", "missing input")



def test_unescape_matches_python_html_unescape(spark):
    import html as pyhtml
    samples = ["caf&eacute; &amp; cr&egrave;me", "&#8217;quote&#x2019; &lt;b&gt; &quot;x&quot;",
               "&nbsp;a&copy;&middot;", "&amp;lt; stays &lt;", "no refs", "&unknownthing; &#128512;", None]
    df = spark.createDataFrame([(x,) for x in samples], "t string")
    got = [r[0] for r in df.select(H.unescape_html("t")).collect()]
    assert got == [None if x is None else pyhtml.unescape(x) for x in samples]
