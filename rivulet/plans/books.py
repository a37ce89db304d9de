"""Book catalogue: raw scrape -> silver -> gold details / gold analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.clean import (
    clean_availability, clean_price_digits, clean_price_strict, clean_reviews, finite, parse_double, processing_time,
)
from rivulet.operators import html as H
from rivulet.operators.aggregates import category_stats
from rivulet.operators.columns import rename_existing
from rivulet.operators.elements import select, spread
from rivulet.operators.joins import scalar_enrich
from rivulet.session import ship_package

# --- fixed values: table and column names of the published tables ---------
RAW_COLUMNS = ("url", "titre", "categorie", "description", "upc", "type_produit", "prix_hors_taxe",
               "prix_ttc", "disponibilite", "nombre_davis", "image_url")
SILVER_RENAMES = {"prix_hors_taxe": "price_excl_tax", "prix_ttc": "price_gbp", "disponibilite": "stock",
                  "nombre_davis": "reviews", "categorie": "category"}
ANALYTICS_NAMES = {"category": "categorie", "count": "nombre_livres", "avg_price": "prix_moyen_gbp",
                   "min_price": "prix_min_gbp", "max_price": "prix_max_gbp", "total_stock": "stock_total",
                   "avg_rating": "avis_moyen"}
# Table labels of a product page and the raw field each one fills.
PRODUCT_TABLE_FIELDS = {"upc": "UPC", "type_produit": "Product Type", "prix_hors_taxe": "Price (excl. tax)",
                        "prix_ttc": "Price (incl. tax)", "disponibilite": "Availability",
                        "nombre_davis": "Number of reviews"}
DEFAULT_CATEGORY = "Books"
SITE_BASE = "https://books.toscrape.com/"
# ---------------------------------------------------------------------------


def book_links(pages: DataFrame, html_col: str = "html", base: str = SITE_BASE) -> DataFrame:
    """Catalogue pages -> one row per product link (``article.product_pod h3 a``).

    Every ``../../`` is removed from the href and ``<base>catalogue/`` is
    prefixed.  Pages are rows, so all catalogue pages are read at once.
    """
    ship_package(pages.sparkSession)
    links = select(F.col(html_col), {"href": ("article.product_pod h3 a", "@href")})["href"]
    return spread(pages.select(html_col)).select(links.alias("links")).select(F.explode("links").alias("href")).filter("href is not null").select(
        F.concat(F.lit(base + "catalogue/"), F.replace(F.col("href"), F.lit("../../"), F.lit(""))).alias("url"))


# What a product page holds where.
PRODUCT_FIELDS = {"main": ("div.product_main", "@class"), "title": ("div.product_main h1", "text"), "crumbs": ("ul.breadcrumb li", "text"),
                  "description": ("div#product_description ~ p", "text"), "image": ("div.item.active img", "@src")}


def book_records(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                 base: str = SITE_BASE) -> tuple[DataFrame, DataFrame]:
    """Product pages -> (raw book rows with the 11 scraped fields, rejected pages).

    A page without a ``div.product_main`` block is rejected with a reason
    instead of failing the run.  Fields: title (h1 of the main block),
    category (third breadcrumb item, default "Books"), description (the
    paragraph after ``#product_description``), the product-table values, and
    the absolute URL of the active image.  Either frame parses each page once, in tasks over all cores; nested elements are balanced.
    """
    ship_package(pages.sparkSession)
    dealt = spread(pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")))
    split = lambda p: H.split_valid(dealt.select("url", p.alias("p")), F.size("p.main") > 0, F.when(
        F.col("p.main").isNotNull(), F.lit("invalid page structure: no product_main block")))
    good = split(select(F.col("html"), PRODUCT_FIELDS, tables="table"))[0]
    bad = split(select(F.col("html"), {"main": PRODUCT_FIELDS["main"]}))[1]
    first = lambda name: F.get(F.col(f"p.{name}"), 0)
    fields = {
        "url": F.col("url"),
        "titre": first("title"),
        "categorie": F.coalesce(F.get("p.crumbs", 2), F.lit(DEFAULT_CATEGORY)),
        "description": first("description"),
        **{k: F.try_element_at("p.table", F.lit(label)) for k, label in PRODUCT_TABLE_FIELDS.items()},
        "image_url": F.when(first("image") != "", H.absolute_url(first("image"), base)),
    }
    return good.select(*[e.alias(k) for k, e in fields.items()]).select(*RAW_COLUMNS), bad.select("url", "reject_reason")


def books_silver(raw: DataFrame, rates: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Clean the scraped book rows.

    ``strict`` parses prices like a float parser after dropping currency noise
    (invalid -> null); otherwise only digits and dots are kept.  Stock is the
    number in "In stock (n available)" (0 when absent), reviews an int (0 when
    null).  With ``rates`` (first row: EUR, USD columns) unrounded EUR/USD
    prices are added.
    """
    price = clean_price_strict if strict else clean_price_digits
    cleaners = {
        "prix_hors_taxe": price,
        "prix_ttc": price,
        "disponibilite": lambda c: clean_availability(c, default=0 if strict else None),
        "nombre_davis": clean_reviews,
    }
    df = raw.withColumns({c: f(c) for c, f in cleaners.items() if c in raw.columns})
    df = rename_existing(df, SILVER_RENAMES)
    return scalar_enrich(df, rates, {"price_eur": ("price_gbp", "EUR"), "price_usd": ("price_gbp", "USD")})


# Numeric columns of the book silver table and their types.
SILVER_TYPES = {"price_excl_tax": "double", "price_gbp": "double", "stock": "int", "reviews": "int",
                "price_eur": "double", "price_usd": "double"}


def typed_books_silver(df: DataFrame) -> DataFrame:
    """Silver rows read back from text (CSV): numeric columns typed with try_cast,
    without a schema-inference pass over the data."""
    return df.withColumns({c: parse_double(c).try_cast(t) for c, t in SILVER_TYPES.items() if c in df.columns})


def finite_prices(silver: DataFrame) -> DataFrame:
    """NaN and infinite prices become null, so that no aggregate or conversion carries them on."""
    return silver.withColumns({c: finite(F.col(c)) for c, t in silver.dtypes if c in SILVER_TYPES and t in ("double", "float")})


def gold_books_details(silver: DataFrame, rates: DataFrame | None = None, as_of=None) -> DataFrame:
    """One row per book with EUR/USD prices rounded to cents and a processing time."""
    silver = finite_prices(silver)
    df = scalar_enrich(silver.drop("price_eur", "price_usd") if rates is not None else silver, rates,
                       {"price_eur": ("price_gbp", "EUR"), "price_usd": ("price_gbp", "USD")}, digits=2)
    return df.withColumn("processed_at", processing_time(as_of))


def gold_books_analytics(silver: DataFrame, rates: DataFrame | None = None, as_of=None,
                         category: str = "category", price: str = "price_gbp",
                         stock: str = "stock", reviews: str = "reviews") -> DataFrame:
    """One row per category: count, mean/min/max price, total stock, mean reviews
    (rounded to 2), then the rounded mean price converted to EUR/USD and rounded again."""
    agg = category_stats(silver, category, price, stock, reviews, names=ANALYTICS_NAMES)
    agg = scalar_enrich(agg, rates, {"prix_moyen_eur": ("prix_moyen_gbp", "EUR"),
                                     "prix_moyen_usd": ("prix_moyen_gbp", "USD")}, digits=2)
    return agg.withColumn("processed_at", processing_time(as_of))


def books_quality(silver: DataFrame) -> DataFrame:
    """Rows and null titles, one scan."""
    return silver.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("titre").isNull()).alias("null_titles"))
