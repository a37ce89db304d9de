import os

from rivulet.plans.books import RAW_COLUMNS, book_links, book_records
from rivulet.plans.runs import (
    books_silver_step, countries_silver_step, gold_books_step, gold_countries_step, population_silver_step,
    wine_silver_step,
)
from rivulet.sinks.files import write, write_csv
from rivulet.sources.files import read_latest_version

PRODUCT = """<html><head><script>var x = "<div class='product_main'><h1>fake</h1></div>";</script></head><body>
<ul class="breadcrumb"><li><a href="../index.html">Home</a></li><li><a href="../books_1/index.html">Books</a></li>
<li><a href="../poetry_23/index.html">Poetry</a></li><li class="active">A Light in the Attic</li></ul>
<div id="product_gallery"><div class="item active"><img src="../../media/cache/fe/72/fe72.jpg" alt="x"/></div></div>
<div class="col-sm-6 product_main"><h1>A Light in the Attic</h1><p class="price_color">£51.77</p></div>
<div id="product_description" class="sub-header"><h2>Product Description</h2></div>
<p>It's hard to imagine &amp; a world without it.</p>
<table class="table table-striped"><tr><th>UPC</th><td>a897fe39b1053632</td></tr>
<tr><th>Product Type</th><td>Books</td></tr><tr><th>Price (excl. tax)</th><td>£51.77</td></tr>
<tr><th>Price (incl. tax)</th><td>£51.77</td></tr><tr><th>Tax</th><td>£0.00</td></tr>
<tr><th>Availability</th><td>In stock (22 available)</td></tr><tr><th>Number of reviews</th><td>0</td></tr></table>
</body></html>"""
MINIMAL = '<div class="product_main"><h1>Bare</h1></div><ul class="breadcrumb"><li>Home</li></ul>'


def test_book_records_and_rejects(spark):
    pages = spark.createDataFrame([("u1", PRODUCT), ("u2", MINIMAL), ("u3", "<html>gone</html>")], "url string, html string")
    good, bad = book_records(pages)
    rows = {r.url: r for r in good.collect()}
    assert good.columns == list(RAW_COLUMNS)
    r = rows["u1"]
    assert (r.titre, r.categorie, r.upc, r.type_produit, r.prix_ttc, r.disponibilite, r.nombre_davis) == (
        "A Light in the Attic", "Poetry", "a897fe39b1053632", "Books", "£51.77", "In stock (22 available)", "0")
    assert r.description == "It's hard to imagine & a world without it."
    assert r.image_url == "https://books.toscrape.com/media/cache/fe/72/fe72.jpg"
    m = rows["u2"]
    assert (m.titre, m.categorie, m.description, m.upc, m.image_url) == ("Bare", "Books", None, None, None)
    assert [(b.url, b.reject_reason.startswith("invalid")) for b in bad.collect()] == [("u3", True)]


def test_steps_end_to_end(spark, tmp_dir):
    pages = spark.createDataFrame([("u1", PRODUCT)], "url string, html string")
    records, _ = book_records(pages)
    raw_csv = os.path.join(tmp_dir, "raw", "books")
    write_csv(records, raw_csv)
    rates = spark.createDataFrame([(1.2, 1.3, "GBP", "d")], "EUR double, USD double, base string, date string")
    write(rates, os.path.join(tmp_dir, "raw", "rates"))
    silver_csv = os.path.join(tmp_dir, "silver", "books")
    assert books_silver_step(spark, raw_csv, silver_csv, os.path.join(tmp_dir, "raw", "rates")) == 1
    counts = gold_books_step(spark, silver_csv, os.path.join(tmp_dir, "gold"), os.path.join(tmp_dir, "raw", "rates"))
    assert counts == {"books_details": 1, "books_analytics": 1}
    g = spark.read.parquet(os.path.join(tmp_dir, "gold", "books_analytics")).first()
    assert (g.categorie, g.prix_moyen_gbp, g.prix_moyen_eur, g.stock_total) == ("Poetry", 51.77, 62.12, 22)
    silver_pq = os.path.join(tmp_dir, "silver", "books_pq")
    assert books_silver_step(spark, raw_csv, silver_pq, os.path.join(tmp_dir, "raw", "rates"), fmt="parquet") == 1
    counts = gold_books_step(spark, silver_pq, os.path.join(tmp_dir, "gold_pq"), os.path.join(tmp_dir, "raw", "rates"),
                             fmt="parquet")
    assert counts == {"books_details": 1, "books_analytics": 1}

    countries = spark.createDataFrame([("Kenya", "Africa", 50, 10.0, "KES", "KE", "KEN")],
                                      "name string, region string, population long, area double, "
                                      "currency_codes string, iso2 string, iso3 string")
    write(countries, os.path.join(tmp_dir, "raw", "countries"))
    assert countries_silver_step(spark, os.path.join(tmp_dir, "raw", "countries"), os.path.join(tmp_dir, "silver", "countries"),
                                 order_by=["name"]) == 1
    n = gold_countries_step(spark, os.path.join(tmp_dir, "silver", "countries"), os.path.join(tmp_dir, "gold"),
                            population_path=os.path.join(tmp_dir, "missing"), rates_path=None)
    assert n == 1
    gc = spark.read.parquet(os.path.join(tmp_dir, "gold", "countries_enriched")).first()
    assert gc.population_banque_mondiale is None and gc.densite_population == 5.0

    pop = spark.createDataFrame([("P", "KE", "Kenya", 2020, 5.0), ("P", "KE", "Kenya", 2020, 5.0)],
                                "indicator_id string, country_iso2 string, country_name string, year int, population double")
    write(pop, os.path.join(tmp_dir, "raw", "population"))
    path, rows = population_silver_step(spark, os.path.join(tmp_dir, "raw", "population"),
                                        os.path.join(tmp_dir, "silver", "population"), os.path.join(tmp_dir, "audit"),
                                        stamp="20240101_000000")
    assert rows == 1 and read_latest_version(spark, os.path.join(tmp_dir, "silver", "population")).count() == 1
    from rivulet.plans.runs import rates_silver_step
    assert rates_silver_step(spark, os.path.join(tmp_dir, "raw", "rates"), os.path.join(tmp_dir, "silver", "rates")) == 1
    bad = spark.createDataFrame([("P", "KE", "Kenya", 2020, -5.0)],
                                "indicator_id string, country_iso2 string, country_name string, year int, population double")
    write(bad, os.path.join(tmp_dir, "raw", "population_bad"))
    assert population_silver_step(spark, os.path.join(tmp_dir, "raw", "population_bad"),
                                  os.path.join(tmp_dir, "silver", "population"), os.path.join(tmp_dir, "audit")) == (None, 0)
    assert read_latest_version(spark, os.path.join(tmp_dir, "silver", "population")).count() == 1
    wine = spark.createDataFrame([("w", "France", "Red", "10", "5")], "title string, country string, variety string, price string, points string")
    write(wine, os.path.join(tmp_dir, "raw", "wine"))
    assert wine_silver_step(spark, os.path.join(tmp_dir, "raw", "wine"), os.path.join(tmp_dir, "silver", "wine"), order_by=["variety"]) == 1


CATALOGUE = """<ol class="row"><li><article class="product_pod"><div class="image_container">
<a href="../../a-light-in-the-attic_1000/index.html"><img src="x.jpg"></a></div>
<h3><a href="../../a-light-in-the-attic_1000/index.html" title="A Light">A Light ...</a></h3></article></li>
<li><article class="product_pod"><h3><a href="tipping-the-velvet_999/index.html">Tipping</a></h3></article></li>
</ol><div class="side"><h3><a href="/not-a-book">x</a></h3></div>"""


def test_book_links(spark):
    pages = spark.createDataFrame([(CATALOGUE,), ("<html></html>",)], "html string")
    assert [r.url for r in book_links(pages).collect()] == [
        "https://books.toscrape.com/catalogue/a-light-in-the-attic_1000/index.html",
        "https://books.toscrape.com/catalogue/tipping-the-velvet_999/index.html"]


def test_silver_steps_keep_the_first_row_of_the_files(spark, tmp_dir):
    """Without an order the first duplicate is the one the raw files hold first, whatever its values."""
    at = lambda p: os.path.join(tmp_dir, p)
    schema = "name string, region string, population long, area double, currency_codes string, iso2 string, iso3 string"
    rows = [("Zeta", "R", 5, 1.0, "KES", "KE", "KEN"), ("Alpha", "R", 6, 1.0, "KES", "KE", "KEN"), ("Mid", "R", 7, 1.0, "TZS", "TZ", "TZA")]
    write(spark.createDataFrame(rows, schema).coalesce(1), at("countries"))
    assert countries_silver_step(spark, at("countries"), at("silver")) == 2
    got = spark.read.parquet(at("silver"))
    assert sorted(r.name for r in got.collect()) == ["Mid", "Zeta"] and "_file_order" not in got.columns
    wine = spark.createDataFrame([("w", "FR", "v", "9", "1"), ("w", "FR", "v", "2", "8")], "title string, country string, variety string, price string, points string")
    write(wine.coalesce(1), at("wine"))
    assert wine_silver_step(spark, at("wine"), at("wine_silver")) == 1
    assert [r.price for r in spark.read.parquet(at("wine_silver")).collect()] == [9.0]
