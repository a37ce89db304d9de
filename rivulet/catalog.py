"""Registered queries over the driver's tables and their DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` built from the library's
operators; ``ORACLE`` holds the equivalent SQL over the same tables.
Computed columns carry the same names on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import fixtures as fx
from rivulet.functions.clean import (
    clean_availability, clean_price_digits, clean_price_strict, clean_reviews, round_half_even, safe_ratio,
)
from rivulet.operators import html as H
from rivulet.operators import metrics as M
from rivulet.operators.aggregates import avg_by, count_by, share_of_total, totals
from rivulet.operators.dedup import dedup_first, distinct_rows
from rivulet.operators.filters import match_labels, positive
from rivulet.operators.flatten import flatten_countries, flatten_observations, flatten_rates, json_field
from rivulet.operators.joins import broadcast_if_small, latest_per_key
from rivulet.operators.keys import dense_ids
from rivulet.operators.quality import duplicate_keys, fk_summary, too_long, violation_counts
from rivulet.operators.topk import top_k, top_k_of_group_max
from rivulet.operators.upsert import append, upsert
from rivulet.plans import bi as BI
from rivulet.plans.books import books_silver, gold_books_analytics, gold_books_details
from rivulet.plans.countries import countries_silver, gold_countries_enriched
from rivulet.plans.load import upsert_versioned
from rivulet.plans.silver import population_silver, wine_silver
from rivulet.session import ensure_checkpoint_dir, own_folder
from rivulet.sinks.files import append_audit, publish, write_csv, write_versioned
from rivulet.sources.files import _fs_and_path, csv_rejects, read_csv, read_latest_version

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark, sf, name):
    return fx.table(spark, sf, name)


# RE2 twin of ``functions.clean.STRIP_PATTERN`` (str.strip() whitespace).
_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
_STRIP_RE = f"^{_WS}+|{_WS}+$"


def _rnd(x: str, d: int = 2) -> str:
    """SQL twin of ``round_half_even``."""
    return f"(round_even(({x}) * {10 ** d}, 0) / {10 ** d})"


def _sql_case(key: str, values: list, modulo: int) -> str:
    parts = [f"WHEN {key} % {modulo} = {i} THEN '{v}'" for i, v in enumerate(values) if v is not None]
    return "CASE " + " ".join(parts) + " END"


_R = fx.RATES
_CODES_SQL = _sql_case("n_nationkey", fx.NATION_CURRENCIES, len(fx.NATION_CURRENCIES))
_RATES_SQL = "(VALUES " + ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in _R.items()) + ") AS rates(currency, rate)"

# --------------------------------------------------------------------------- gold
_BOOKS_SQL = "SELECT p_partkey AS upc, p_name AS titre, p_type AS category, " \
             "CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE p_retailprice END AS price_gbp, p_size AS stock, p_partkey % 6 AS reviews FROM part"


@register("gold_category_analytics", f"""
SELECT categorie, nombre_livres, prix_moyen_gbp, prix_min_gbp, prix_max_gbp, stock_total, avis_moyen,
       {_rnd(f"prix_moyen_gbp * CAST({_R['EUR']} AS DOUBLE)")} AS prix_moyen_eur,
       {_rnd(f"prix_moyen_gbp * CAST({_R['USD']} AS DOUBLE)")} AS prix_moyen_usd
FROM (SELECT category AS categorie, COUNT(*) AS nombre_livres,
             {_rnd('AVG(price_gbp)')} AS prix_moyen_gbp, {_rnd('MIN(price_gbp)')} AS prix_min_gbp,
             {_rnd('MAX(price_gbp)')} AS prix_max_gbp, CAST(COALESCE(SUM(stock), 0) AS BIGINT) AS stock_total,
             {_rnd('AVG(reviews)')} AS avis_moyen
      FROM ({_BOOKS_SQL}) b WHERE category IS NOT NULL GROUP BY category) g
""")
def gold_category_analytics(spark, sf):
    silver = fx.books_silver_from_part(_t(spark, sf, "part"))
    return gold_books_analytics(silver, fx.rates_row(spark)).drop("processed_at")


@register("gold_details_converted", f"""
SELECT upc, titre, category, price_gbp, stock, reviews,
       {_rnd(f"price_gbp * CAST({_R['EUR']} AS DOUBLE)")} AS price_eur,
       {_rnd(f"price_gbp * CAST({_R['USD']} AS DOUBLE)")} AS price_usd
FROM ({_BOOKS_SQL}) b
""")
def gold_details_converted(spark, sf):
    silver = fx.books_silver_from_part(_t(spark, sf, "part"))
    return gold_books_details(silver, fx.rates_row(spark)).drop("processed_at")


@register("latest_per_key_ties", """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS latest_orderdate
FROM (SELECT *, RANK() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC) AS rk
      FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL) t
WHERE rk = 1
""")
def latest_per_key_ties(spark, sf):
    o = _t(spark, sf, "orders").withColumn("latest_orderdate", F.col("o_orderdate").cast("date"))
    return latest_per_key(o, "o_custkey", "latest_orderdate").select(
        "o_custkey", "o_orderkey", "o_totalprice", "latest_orderdate")


@register("enriched_left_join", f"""
WITH c AS (
  SELECT c.c_name AS pays, upper(c.c_name) AS nom_officiel, c.c_custkey AS iso2, c.c_name AS iso3,
         r.r_name AS region, n.n_name AS sous_region, n.n_name AS capitale, c.c_nationkey AS superficie_km2,
         c.c_acctbal AS population_api_countries, {_CODES_SQL} AS codes_devises
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
p AS (
  SELECT o_custkey, o_totalprice AS population_banque_mondiale, d AS annee_population
  FROM (SELECT o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS d,
               RANK() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC) AS rk
        FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL) t WHERE rk = 1)
SELECT c.pays, c.nom_officiel, c.iso2, c.iso3, c.region, c.sous_region, c.capitale, c.superficie_km2,
       c.population_api_countries, p.population_banque_mondiale, p.annee_population,
       {_rnd('c.population_api_countries / NULLIF(CAST(c.superficie_km2 AS DOUBLE), 0)')} AS densite_population,
       c.codes_devises, regexp_replace(split_part(c.codes_devises, ',', 1), '{_STRIP_RE}', '', 'g') AS devise_principale,
       rates.rate AS taux_change_vs_gbp
FROM c LEFT JOIN p ON c.iso2 = p.o_custkey
       LEFT JOIN {_RATES_SQL} ON regexp_replace(split_part(c.codes_devises, ',', 1), '{_STRIP_RE}', '', 'g') = rates.currency
""")
def enriched_left_join(spark, sf):
    countries = fx.countries_from_customers(_t(spark, sf, "customer"), _t(spark, sf, "nation"),
                                            _t(spark, sf, "region"))
    population = fx.population_from_orders(_t(spark, sf, "orders"))
    return gold_countries_enriched(countries, population, fx.rates_row(spark)).drop("processed_at")


# ------------------------------------------------------------------- cleaning
_MONEY_SQL = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)"
_PRICE_TEXT_SQL = f"""CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 23 = 0 THEN '1d'
  WHEN p_partkey % 19 = 0 THEN '1.2.3' WHEN p_partkey % 17 = 0 THEN '-5.00' WHEN p_partkey % 13 = 0 THEN '.'
  WHEN p_partkey % 11 = 0 THEN 'Â£' || {_MONEY_SQL} WHEN p_partkey % 7 = 0 THEN 'invalid'
  WHEN p_partkey % 31 = 0 THEN 'nan' WHEN p_partkey % 37 = 0 THEN '£inf' WHEN p_partkey % 41 = 0 THEN ' 12.5e1 '
  ELSE '£' || {_MONEY_SQL} END"""
_FLOAT_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


@register("clean_price_strict", f"""
SELECT p_partkey, price_text,
       CASE WHEN regexp_matches(t, '{_FLOAT_RE}') THEN TRY_CAST(t AS DOUBLE) END AS price
FROM (SELECT p_partkey, price_text,
             regexp_replace(replace(replace(price_text, '£', ''), 'Â', ''), '{_STRIP_RE}', '', 'g') AS t
      FROM (SELECT p_partkey, {_PRICE_TEXT_SQL} AS price_text FROM part) a) b
""")
def q_clean_price_strict(spark, sf):
    p = _t(spark, sf, "part")
    x = p.select("p_partkey", fx.price_text(p).alias("price_text"))
    return x.withColumn("price", clean_price_strict("price_text"))


@register("clean_price_digits", f"""
SELECT p_partkey, price_text, TRY_CAST(NULLIF(regexp_replace(price_text, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS price
FROM (SELECT p_partkey, {_PRICE_TEXT_SQL} AS price_text FROM part) a
""")
def q_clean_price_digits(spark, sf):
    p = _t(spark, sf, "part")
    x = p.select("p_partkey", fx.price_text(p).alias("price_text"))
    return x.withColumn("price", clean_price_digits("price_text"))


@register("clean_availability", """
SELECT p_partkey, availability, COALESCE(TRY_CAST(regexp_extract(availability, '\\((\\d+)', 1) AS INTEGER), 0) AS stock
FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 5 THEN 'Empty'
             ELSE 'In stock (' || CAST(p_size AS VARCHAR) || ' available)' END AS availability FROM part) a
""")
def q_clean_availability(spark, sf):
    p = _t(spark, sf, "part")
    return (p.select("p_partkey", fx.availability_text(p).alias("availability"))
             .withColumn("stock", clean_availability("availability")))


@register("clean_reviews", """
SELECT p_partkey, reviews_text,
       CASE WHEN regexp_matches(reviews_text, '^[0-9.]+$') THEN CAST(CAST(reviews_text AS DOUBLE) AS INTEGER) ELSE 0 END AS reviews
FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 4 THEN CAST(p_size AS VARCHAR) || '.0'
             WHEN p_partkey % 9 = 7 THEN 'n/a' WHEN p_partkey % 9 = 5 THEN '1d' ELSE CAST(p_size AS VARCHAR) END AS reviews_text FROM part) a
""")
def q_clean_reviews(spark, sf):
    p = _t(spark, sf, "part")
    return (p.select("p_partkey", fx.reviews_text(p).alias("reviews_text"))
             .withColumn("reviews", clean_reviews("reviews_text")))


@register("ratio_safe", """
SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_discount, 0) AS price_per_discount FROM lineitem
""")
def ratio_safe(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     safe_ratio("l_extendedprice", "l_discount").alias("price_per_discount"))


@register("dedup_first", """
SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders) t WHERE rn = 1
""")
def q_dedup_first(spark, sf):
    o = _t(spark, sf, "orders")
    return dedup_first(o, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@register("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def q_distinct_rows(spark, sf):
    return distinct_rows(_t(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


@register("positive_filter", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND NOT isnan(c_acctbal)
""")
def q_positive_filter(spark, sf):
    return positive(_t(spark, sf, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@register("year_month", """
SELECT DISTINCT 'SP.POP.TOTL' AS indicator_id, o_custkey AS country_iso2, o_orderpriority AS country_name,
       CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice - 250000 AS population,
       CAST(year(o_orderdate) AS VARCHAR) || '-01' AS year_month
FROM orders WHERE o_totalprice - 250000 > 0 AND NOT isnan(o_totalprice - 250000)
""")
def q_year_month(spark, sf):
    raw = _t(spark, sf, "orders").select(
        F.lit("SP.POP.TOTL").alias("indicator_id"), F.col("o_custkey").alias("country_iso2"),
        F.col("o_orderpriority").alias("country_name"), F.year("o_orderdate").alias("year"),
        (F.col("o_totalprice") - 250000).alias("population"))
    return population_silver(raw).drop("ingestion_timestamp")


# ------------------------------------------------------------------------- BI
@register("bi_count_by_group", "SELECT p_type, COUNT(*) AS nb FROM part GROUP BY p_type")
def bi_count_by_group(spark, sf):
    return count_by(_t(spark, sf, "part"), "p_type", "nb")


@register("bi_sum_share", f"""
SELECT l_returnflag, {_rnd('revenue')} AS revenue, {_rnd('revenue / SUM(revenue) OVER ()', 6)} AS share
FROM (SELECT l_returnflag, SUM(l_extendedprice) AS revenue FROM lineitem GROUP BY l_returnflag) g
""")
def bi_sum_share(spark, sf):
    s = share_of_total(_t(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", "revenue", "share")
    return s.select("l_returnflag", round_half_even("revenue", 2).alias("revenue"), round_half_even("share", 6).alias("share"))


@register("bi_avg_filtered", f"""
SELECT c_mktsegment, {_rnd('AVG(c_acctbal)')} AS avg_acctbal FROM customer
WHERE c_acctbal IS NOT NULL GROUP BY c_mktsegment
""")
def bi_avg_filtered(spark, sf):
    a = avg_by(_t(spark, sf, "customer"), "c_mktsegment", "c_acctbal", "avg_acctbal",
               where=F.col("c_acctbal").isNotNull())
    return a.select("c_mktsegment", round_half_even("avg_acctbal", 2).alias("avg_acctbal"))


@register("bi_global", f"""
SELECT COUNT(*) AS n_lines, {_rnd('SUM(l_quantity)')} AS total_qty, {_rnd('SUM(l_extendedprice)')} AS revenue
FROM lineitem
""")
def bi_global(spark, sf):
    return totals(_t(spark, sf, "lineitem"), {
        "n_lines": F.count(F.lit(1)), "total_qty": round_half_even(F.sum("l_quantity"), 2),
        "revenue": round_half_even(F.sum("l_extendedprice"), 2)})


@register("bi_top10", """
SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC NULLS FIRST, p_partkey LIMIT 10
""")
def bi_top10(spark, sf):
    return top_k(_t(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"),
                 "p_retailprice", 10, ["p_partkey"])


@register("bi_top20_filtered", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL
ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def bi_top20_filtered(spark, sf):
    o = _t(spark, sf, "orders").filter((F.col("o_orderstatus") == "F") & F.col("o_totalprice").isNotNull())
    return top_k(o.select("o_orderkey", "o_custkey", "o_totalprice"), "o_totalprice", 20, ["o_orderkey"])


@register("bi_top_group_max", """
SELECT o_custkey, MAX(o_totalprice) AS max_totalprice FROM orders GROUP BY o_custkey
ORDER BY max_totalprice DESC NULLS FIRST, o_custkey LIMIT 10
""")
def bi_top_group_max(spark, sf):
    return top_k_of_group_max(_t(spark, sf, "orders"), "o_custkey", "o_totalprice", 10, "max_totalprice")


@register("bi_detail_table", """
SELECT c.c_custkey, c.c_name, n.n_name, c.c_acctbal FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def bi_detail_table(spark, sf):
    c, n = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    n = broadcast_if_small(n.select("n_nationkey", "n_name"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "c_name", "n_name", "c_acctbal")


# ----------------------------------------------------------------------- JSON
@register("json_props", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_props(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", json_field("props", "$.k", "int").alias("k"))


def _names_sql() -> str:
    parts = []
    for i, v in enumerate(fx.NATION_CURRENCIES):
        if v:
            names = ", ".join(f"{c} money" for c in v.split(", "))
            parts.append(f"WHEN n_nationkey % {len(fx.NATION_CURRENCIES)} = {i} THEN '{names}'")
    return "CASE " + " ".join(parts) + " END"


def _langs_sql() -> str:
    parts = [f"WHEN n_nationkey % {len(fx.NATION_LANGUAGES)} = {i} THEN '{', '.join(v.values())}'"
             for i, v in enumerate(fx.NATION_LANGUAGES) if v]
    return "CASE " + " ".join(parts) + " END"


@register("json_flatten", f"""
SELECT c.c_name AS name, upper(c.c_name) AS official_name, r.r_name AS region, n.n_name AS subregion,
       c.c_custkey * 1000 AS population, c.c_acctbal AS area,
       CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE n.n_name END AS capital,
       {_langs_sql()} AS languages, {_names_sql()} AS currencies,
       NULLIF({_CODES_SQL}, '') AS currency_codes, CAST(c.c_custkey AS VARCHAR) AS iso2, c.c_name AS iso3
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def json_flatten(spark, sf):
    payloads = fx.country_payloads(_t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region"))
    return flatten_countries(payloads)


@register("json_population_pages", """
SELECT 'SP.POP.TOTL' AS indicator_id, CAST(o_custkey AS VARCHAR) AS country_iso2, o_orderpriority AS country_name,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year,
       o_totalprice AS population
FROM orders WHERE o_orderstatus <> 'P'
""")
def json_population_pages(spark, sf):
    return flatten_observations(fx.population_pages(_t(spark, sf, "orders")))


@register("json_rates", """
SELECT MIN(value) AS USD, MAX(value) AS EUR, CAST(COUNT(*) AS DOUBLE) AS ZAR, CAST(NULL AS DOUBLE) AS NGN,
       CAST(NULL AS DOUBLE) AS KES, CAST(NULL AS DOUBLE) AS EGP, 'GBP' AS base, strftime(ts, '%Y-%m-%d') AS date
FROM events GROUP BY strftime(ts, '%Y-%m-%d')
""")
def json_rates(spark, sf):
    return flatten_rates(fx.rate_payloads(_t(spark, sf, "events")))


# ----------------------------------------------------------------------- HTML
_DECOY_SQL = r"regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g')"


def _text_sql(x: str) -> str:
    t = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        t = f"replace({t}, '{ent}', '{ch}')"
    return f"regexp_replace({t}, '{_STRIP_RE}', '', 'g')"


def _has_sql(src: str, tag: str, attrs: str = "") -> str:
    attr = f"[^>]*{attrs}" if attrs else ""
    return f"regexp_matches({src}, '(?is)<{tag}\\b{attr}[^>]*>')"


def _elem_text_sql(src: str, tag: str, attrs: str = "") -> str:
    """SQL twin of ``html.element_text``: null when absent, '' when empty."""
    return f"CASE WHEN {_has_sql(src, tag, attrs)} THEN {_text_sql(_inner_sql(src, tag, attrs))} END"


def _inner_sql(src: str, tag: str, attrs: str = "") -> str:
    attr = f"[^>]*{attrs}" if attrs else ""
    return f"regexp_extract({src}, '(?is)<{tag}\\b{attr}[^>]*>(.*?)</{tag}\\s*>', 1)"


_LI_SQL = r"'(?is)<li\b[^>]*>(.*?)</li\s*>'"
_HREF_SQL = r"""'(?is)<a\b[^>]*?\shref\s*=\s*"([^"]*)"'"""


@register("html_links", f"""
WITH n AS (SELECT page_id, {_inner_sql(_DECOY_SQL, 'nav')} AS nav FROM pages),
l AS (SELECT page_id, regexp_extract_all(nav, {_HREF_SQL}, 1) AS hrefs FROM n)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos,
       CASE WHEN regexp_matches(hrefs[i], '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN hrefs[i]
            ELSE '{fx.LINK_BASE}' || regexp_replace(regexp_replace(hrefs[i], '^(\\.\\./)+', ''), '^/+', '') END AS link,
       regexp_extract(hrefs[i], '^/(.*)$', 1) AS label
FROM l, range(1, len(hrefs) + 1) t(i)
""")
def html_links(spark, sf):
    p = _t(spark, sf, "pages")
    nav = H.element_inner(H.strip_decoys("html"), "nav")
    x = p.select("page_id", F.posexplode(H.link_hrefs(nav)).alias("pos", "href"))
    return x.select("page_id", "pos", H.absolute_url("href", fx.LINK_BASE).alias("link"),
                    H.relabel("href").alias("label"))


@register("html_fields", f"""
WITH c AS (SELECT page_id, html, {_DECOY_SQL} AS h FROM pages)
SELECT page_id,
       regexp_extract(html, '(?is)<html\\b[^>]*\\blang="([^"]*)"', 1) AS lang,
       {_elem_text_sql('h', 'title')} AS title,
       {_elem_text_sql(_inner_sql('h', 'article'), 'h1')} AS h1,
       CAST(len(regexp_extract_all({_inner_sql('h', 'nav')}, {_LI_SQL}, 1)) AS INTEGER) AS nav_items,
       COALESCE({_text_sql(f"regexp_extract_all({_inner_sql('h', 'nav')}, {_LI_SQL}, 1)[3]")}, 'Books') AS third_item,
       {_elem_text_sql('h', 'div', 'class="ad"')} AS ad_text,
       {_elem_text_sql(_inner_sql('h', 'article'), 'p')} AS first_paragraph
FROM c
""")
def html_fields(spark, sf):
    p = _t(spark, sf, "pages").withColumn("h", H.strip_decoys("html"))
    nav = H.element_inner("h", "nav")
    article = H.element_inner("h", "article")
    return p.select(
        "page_id",
        F.regexp_extract("html", r'(?is)<html\b[^>]*\blang="([^"]*)"', 1).alias("lang"),
        H.element_text("h", "title").alias("title"),
        H.element_text(article, "h1").alias("h1"),
        F.size(H.list_items(nav)).alias("nav_items"),
        H.nth_item_text(nav, 2, "Books").alias("third_item"),
        H.element_text("h", "div", 'class="ad"').alias("ad_text"),
        H.element_text(article, "p").alias("first_paragraph"))


@register("rejects_split", f"""
WITH b AS (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN replace(replace(html, '<article>', '<section>'),
                                   '</article>', '</section>') ELSE html END AS html FROM pages),
c AS (SELECT page_id, {_DECOY_SQL} AS h FROM b)
SELECT page_id,
       CASE WHEN regexp_matches(h, '(?is)<article\\b[^>]*>') AND regexp_matches(h, '(?is)<h1\\b[^>]*>') THEN 'ok' ELSE 'rejected' END AS status,
       CASE WHEN NOT regexp_matches(h, '(?is)<article\\b[^>]*>') THEN 'missing article'
            WHEN NOT regexp_matches(h, '(?is)<h1\\b[^>]*>') THEN 'missing h1' END AS reject_reason,
       CASE WHEN regexp_matches(h, '(?is)<article\\b[^>]*>') AND regexp_matches(h, '(?is)<h1\\b[^>]*>')
            THEN {_elem_text_sql(_inner_sql('h', 'article'), 'h1')} END AS h1
FROM c
""")
def rejects_split(spark, sf):
    p = _t(spark, sf, "pages")
    broken = F.when(F.col("page_id") % 10 == 0,
                    F.replace(F.replace("html", F.lit("<article>"), F.lit("<section>")),
                              F.lit("</article>"), F.lit("</section>"))).otherwise(F.col("html"))
    p = p.select("page_id", H.strip_decoys(broken).alias("h"))
    has_article, has_h1 = H.has_element("h", "article"), H.has_element("h", "h1")
    reason = F.when(~has_article, "missing article").when(~has_h1, "missing h1")
    tagged = H.with_validity(p, has_article & has_h1, reason)
    h1 = H.element_text(H.element_inner("h", "article"), "h1")
    return tagged.select("page_id", "status", "reject_reason",
                         F.when(F.col("status") == "ok", h1).alias("h1"))


# ------------------------------------------------------------ writes as frames
@register("union_append", """
SELECT o_orderkey, o_totalprice, NULL AS source FROM orders WHERE o_orderkey % 2 = 0
UNION ALL
SELECT o_orderkey, o_totalprice, 'second' AS source FROM orders WHERE o_orderkey % 2 = 1
""")
def union_append(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    first = o.filter(F.col("o_orderkey") % 2 == 0)
    second = o.filter(F.col("o_orderkey") % 2 == 1).withColumn("source", F.lit("second"))
    return append(first, second).select("o_orderkey", "o_totalprice", "source")


def _upsert_inputs(spark, sf):
    """Target: orders whose key is not a multiple of 3.  Batch: keys that are
    multiples of 2 or 3 (updates and inserts), status 'U', price +10% (null
    for multiples of 10).  Together they cover every order."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    target = o.filter(F.col("o_orderkey") % 3 != 0)
    updates = (o.filter((F.col("o_orderkey") % 3 == 0) | (F.col("o_orderkey") % 2 == 0))
                .withColumn("o_orderstatus", F.lit("U"))
                .withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("double"))
                            .otherwise(round_half_even(F.col("o_totalprice") * 1.1, 2))))
    return target, updates


@register("upsert_orders", f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0),
u AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus,
             CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {_rnd('o_totalprice * 1.1')} END AS o_totalprice
      FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0)
SELECT COALESCE(t.o_orderkey, u.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey ELSE u.o_custkey END AS o_custkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderstatus ELSE u.o_orderstatus END AS o_orderstatus,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t FULL OUTER JOIN u ON t.o_orderkey = u.o_orderkey
""")
def upsert_orders(spark, sf):
    target, updates = _upsert_inputs(spark, sf)
    return upsert(target, updates, ["o_orderkey"], ["o_totalprice"])


# ---------------------------------------------------------------- constraints
@register("check_unique", """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day, COUNT(*) AS n FROM orders
GROUP BY o_custkey, CAST(o_orderdate AS DATE) HAVING COUNT(*) > 1
""")
def check_unique(spark, sf):
    o = _t(spark, sf, "orders").withColumn("order_day", F.col("o_orderdate").cast("date"))
    return duplicate_keys(o, ["o_custkey", "order_day"])


@register("check_fk", """
SELECT COUNT(*) AS checked,
       COUNT(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)) AS orphans
FROM lineitem WHERE l_orderkey IS NOT NULL
""")
def check_fk(spark, sf):
    return fk_summary(_t(spark, sf, "lineitem"), _t(spark, sf, "orders"), "l_orderkey", "o_orderkey")


@register("check_not_null", """
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE text IS NULL) AS null_text,
       COUNT(*) FILTER (WHERE lang IS NULL) AS null_lang, COUNT(*) FILTER (WHERE source IS NULL) AS null_source,
       COUNT(*) FILTER (WHERE length(text) > 20000) AS too_long_text, COUNT(*) FILTER (WHERE length(lang) > 2) AS too_long_lang
FROM documents
""")
def check_not_null(spark, sf):
    return violation_counts(_t(spark, sf, "documents"), ["text", "lang", "source"], {"text": 20000, "lang": 2})


@register("check_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents WHERE length(text) > 20000")
def check_length(spark, sf):
    d = _t(spark, sf, "documents")
    return too_long(d, "text", 20000).select("doc_id", F.length("text").alias("n_chars"))


@register("surrogate_keys", """
SELECT DENSE_RANK() OVER (ORDER BY p_brand) AS id, p_brand FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL) b
""")
def surrogate_keys(spark, sf):
    return dense_ids(_t(spark, sf, "part"), "p_brand", "id")


# -------------------------------------------------------------------- metrics
_SAMPLES_SQL = """
s AS (SELECT event_id, ts, COALESCE(event_type, '') AS job, COALESCE(CAST(user_id % 4 AS VARCHAR), '') AS instance, value,
             CAST(ROUND(value * 100) AS BIGINT) AS inc, CASE WHEN value >= 10 THEN 1 ELSE 0 END AS up FROM events),
c AS (SELECT *, CAST(SUM(inc) OVER (PARTITION BY job, instance ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS counter FROM s)"""
_STEP_SQL = "CASE WHEN ts = date_trunc('hour', ts) THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END"
def _rate_sql(window_minutes: int = 1440, slide_minutes: int = 360) -> str:
    """Oracle CTEs for rate(): lag per series, every sliding window of each sample."""
    slide_us = slide_minutes * 60_000_000
    k = window_minutes // slide_minutes
    ks = ", ".join(str(i) for i in range(k))
    return f"""
WITH {_SAMPLES_SQL},
p AS (SELECT *, LAG(ts) OVER w AS prev_ts, LAG(counter) OVER w AS prev_value FROM c
      WINDOW w AS (PARTITION BY job, instance ORDER BY ts, event_id)),
x AS (SELECT p.*, make_timestamp(((epoch_us(ts) - 1) // {slide_us} - k) * {slide_us}) AS window_start
      FROM p, (SELECT unnest([{ks}]) AS k) ks),
r AS (SELECT window_start, window_start + INTERVAL {window_minutes} MINUTE AS window_end, job, instance,
             COUNT(*) AS samples,
             CAST(COALESCE(SUM(CASE WHEN prev_ts > window_start THEN
                  (CASE WHEN counter < prev_value THEN counter ELSE counter - prev_value END) END), 0) AS DOUBLE) AS increase,
             (epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / CAST(1000000 AS DOUBLE) AS elapsed_s
      FROM x GROUP BY ALL)
"""


_RATE_SQL = _rate_sql()


def _samples(spark, sf):
    return fx.metric_samples(_t(spark, sf, "events"))


def _counters(spark, sf):
    return M.counter_from_increments(_samples(spark, sf), ["job", "instance"], "ts", "inc", "event_id",
                                     out="counter").withColumn("counter", F.col("counter").cast("double"))


def _counters_only(spark, sf):
    return _counters(spark, sf).drop(M.BUCKET)


@register("metric_counter", f"""
WITH {_SAMPLES_SQL}
SELECT event_id, job, instance, counter FROM c
""")
def metric_counter(spark, sf):
    return _counters(spark, sf).select("event_id", "job", "instance", "counter")


@register("metric_instant", f"""
WITH {_SAMPLES_SQL},
v AS (SELECT *, {_STEP_SQL} AS step FROM c)
SELECT step, job, instance, counter, sample_ts FROM (
  SELECT step, job, instance, counter, MAX(ts) OVER (PARTITION BY step, job, instance) AS sample_ts,
         ROW_NUMBER() OVER (PARTITION BY step, job, instance ORDER BY ts DESC, event_id DESC) AS rn FROM v) t
WHERE rn = 1
""")
def metric_instant(spark, sf):
    return M.instant_range(_counters_only(spark, sf), ["job", "instance"], "ts", "counter",
                           step_seconds=3600, lookback_seconds=3600, tiebreak="event_id")


@register("metric_rate_1d", _RATE_SQL + """
SELECT window_start, window_end, job, instance, samples, increase,
       CASE WHEN samples >= 2 THEN """ + _rnd('increase / NULLIF(elapsed_s, 0)', 6) + """ END AS rate FROM r
""")
def metric_rate_1d(spark, sf):
    return M.counter_rate_from_increments(_samples(spark, sf), ["job", "instance"], "ts", "inc", "event_id",
                                          window="1 day", slide="6 hours")


@register("metric_sum_rate", _RATE_SQL + """
SELECT window_start, window_end, job, """ + _rnd('SUM(rate)', 6) + """ AS rate FROM (
  SELECT window_start, window_end, job, CASE WHEN samples >= 2 THEN """ + _rnd('increase / NULLIF(elapsed_s, 0)', 6) + """ END AS rate
  FROM r) q GROUP BY window_start, window_end, job
""")
def metric_sum_rate(spark, sf):
    r = M.counter_rate_from_increments(_samples(spark, sf), ["job", "instance"], "ts", "inc", "event_id",
                                       window="1 day", slide="6 hours")
    return M.sum_by(r, ["job"], "rate")


@register("metric_health", f"""
WITH {_SAMPLES_SQL},
v AS (SELECT step, job, instance, up FROM (
        SELECT *, {_STEP_SQL} AS step FROM s) a
      QUALIFY ROW_NUMBER() OVER (PARTITION BY step, job, instance ORDER BY ts DESC, event_id DESC) = 1),
sums AS (SELECT step, job, CAST(SUM(up) AS BIGINT) AS up FROM v GROUP BY step, job),
jobs(job) AS (VALUES {", ".join(f"('{j}')" for j in fx.EVENT_JOBS + ["never_seen"])}),
grid AS (SELECT job, unnest(generate_series((SELECT MIN(step) FROM sums), (SELECT MAX(step) + INTERVAL 5 HOUR FROM sums), INTERVAL 1 HOUR)) AS step
         FROM jobs)
SELECT g.step, g.job, s.up,
       CASE WHEN s.up IS NULL THEN 'Offline' WHEN s.up >= 1 THEN 'green' ELSE 'red' END AS status
FROM grid g LEFT JOIN sums s ON g.step = s.step AND g.job = s.job
""")
def metric_health(spark, sf):
    """Five hours beyond the last sample, and for a job that never reported."""
    s = _samples(spark, sf)
    v = M.instant_range(s, ["job", "instance"], "ts", "up", 3600, 3600, "event_id")
    # the jobs that a scrape configuration lists: the known kinds of events, and one that never reports
    jobs = spark.createDataFrame([(j,) for j in fx.EVENT_JOBS + ["never_seen"]], "job string")
    return M.health_status(v, "job", "up", 3600, jobs, extra_steps=5).select("step", "job", "up", "status")


@register("metric_uptime", """
SELECT job, instance, MIN(ts) AS start_ts,
       (epoch_us((SELECT MAX(ts) FROM events)) - epoch_us(MIN(ts))) / CAST(1000000 AS DOUBLE) AS uptime_s
FROM (SELECT ts, COALESCE(event_type, '') AS job, COALESCE(CAST(user_id % 4 AS VARCHAR), '') AS instance FROM events) s
GROUP BY job, instance
""")
def metric_uptime(spark, sf):
    s = _samples(spark, sf)
    as_of = s.select(F.max("ts")).scalar()
    return M.uptime(s, ["job", "instance"], "ts", as_of)


@register("metric_gauge_uptime", """
WITH s AS (SELECT ts, event_id, COALESCE(event_type, '') AS job, COALESCE(CAST(user_id % 4 AS VARCHAR), '') AS instance,
                  CAST(epoch_us(date_trunc('day', ts)) // 1000000 + event_id % 3600 AS DOUBLE) AS start_s FROM events),
a AS (SELECT MAX(ts) AS now_ts FROM events)
SELECT job, instance, start_s, epoch_us(now_ts) / CAST(1000000 AS DOUBLE) - start_s AS uptime_s FROM s, a
WHERE ts > now_ts - INTERVAL 6 HOUR AND ts <= now_ts
QUALIFY ROW_NUMBER() OVER (PARTITION BY job, instance ORDER BY ts DESC, event_id DESC) = 1
""")
def metric_gauge_uptime(spark, sf):
    """``time() - process_start_time_seconds`` from the start time each series last reported."""
    s = _samples(spark, sf)
    day = M.epoch_micros(s, "ts") - F.pmod(M.epoch_micros(s, "ts"), F.lit(86_400_000_000))
    s = s.withColumn("start_s", ((day / 1_000_000).cast("long") + F.col("event_id") % 3600).cast("double"))
    return M.gauge_uptime(s, ["job", "instance"], "ts", "start_s", s.select(F.max("ts")).scalar(), 21600, "event_id")


_RESET_SQL = f"""
WITH {_SAMPLES_SQL},
raw AS (SELECT event_id, ts, job, instance, CAST(counter AS BIGINT) % 20011 AS reading FROM c WHERE event_id % 10 <> 3),
p AS (SELECT *, LAG(ts) OVER w AS prev_ts, LAG(reading) OVER w AS prev_reading FROM raw
      WINDOW w AS (PARTITION BY job, instance ORDER BY ts, event_id)),
x AS (SELECT p.*, make_timestamp(((epoch_us(ts) - 1) // 21600000000 - k) * 21600000000) AS window_start
      FROM p, (SELECT unnest([0, 1, 2, 3]) AS k) ks),
r AS (SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, job, instance, COUNT(*) AS samples,
             CAST(COALESCE(SUM(CASE WHEN prev_ts > window_start THEN
                  CASE WHEN reading < prev_reading THEN reading ELSE reading - prev_reading END END), 0) AS DOUBLE) AS increase,
             (epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / CAST(1000000 AS DOUBLE) AS elapsed_s
      FROM x GROUP BY ALL)
SELECT window_start, window_end, job, instance, samples, increase,
       CASE WHEN samples >= 2 THEN {_rnd('increase / NULLIF(elapsed_s, 0)', 6)} END AS rate FROM r
"""


def _readings(spark, sf):
    """Raw counter readings that start again from zero whenever they reach 20011; every tenth one is null."""
    reading = F.when(F.col("event_id") % 10 != 3, F.col("counter").cast("long") % 20011)
    return _counters_only(spark, sf).select("event_id", "ts", "job", "instance", reading.alias("reading"))


@register("metric_rate_counter", _RESET_SQL)
def metric_rate_counter(spark, sf):
    """``rate()`` of raw readings with resets."""
    return M.counter_rate(_readings(spark, sf), ["job", "instance"], "ts", "reading", "event_id", "1 day", "6 hours")


@register("metric_rate_extrapolated", _RESET_SQL[:_RESET_SQL.index("SELECT window_start, window_end, job, instance, samples, increase,\n")].rstrip()
          .replace("(epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / CAST(1000000 AS DOUBLE) AS elapsed_s",
                   "(epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / CAST(1000000 AS DOUBLE) AS elapsed_s, "
                   "CAST(ARG_MIN(reading, (ts, event_id)) AS DOUBLE) AS first_v, epoch_us(MIN(ts)) AS lo, epoch_us(MAX(ts)) AS hi") + f"""
, w AS (SELECT *, (lo - epoch_us(window_start)) / CAST(1000000 AS DOUBLE) AS before_s, (epoch_us(window_end) - hi) / CAST(1000000 AS DOUBLE) AS after_s FROM r)
, g AS (SELECT *, elapsed_s / (samples - 1) AS gap,
               CASE WHEN increase > 0 THEN LEAST(before_s, elapsed_s * first_v / increase) ELSE before_s END AS reach FROM w WHERE samples >= 2 AND elapsed_s > 0),
e AS (SELECT window_start, job, instance, {_rnd("""increase * ((elapsed_s + CASE WHEN reach >= gap * 1.1 THEN gap / 2 ELSE reach END
             + CASE WHEN after_s >= gap * 1.1 THEN gap / 2 ELSE after_s END) / elapsed_s) / CAST(86400 AS DOUBLE)""", 6)} AS rate FROM g)
SELECT r.window_start, r.window_end, r.job, r.instance, r.samples, r.increase, e.rate
FROM r LEFT JOIN e ON r.window_start = e.window_start AND r.job = e.job AND r.instance = e.instance
""")
def metric_rate_extrapolated(spark, sf):
    """``rate()`` of raw readings with resets, extended to the windows' borders."""
    return M.counter_rate(_readings(spark, sf), ["job", "instance"], "ts", "reading", "event_id", "1 day", "6 hours", extrapolate=True)


def in_time_order(spark, folder: str) -> None:
    """Let the part files' modification times follow their numbers, as if written one after the other."""
    fs, p = _fs_and_path(spark, folder)
    files = sorted((st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")), key=lambda q: q.getName())
    for i, f in enumerate(files):
        fs.setTimes(f, 1_700_000_000_000 + 1000 * i, -1)


@register("stream_counter_resets", _RESET_SQL + """WHERE window_end <=
    (SELECT MAX(ts) FROM events WHERE event_id % 10 <> 3) - INTERVAL 10 MINUTE - INTERVAL 1 MICROSECOND""")
def stream_counter_resets(spark, sf):
    """The same readings as a stream of several files, out of order within each file, null readings among them."""
    from rivulet.streaming.rate import counter_rate_stream, run_available_now
    root = _io_root(spark, "resets")
    readings = _readings(spark, sf)
    # a file per twelfth of the time; inside a file the samples are shuffled by id hash
    readings.repartitionByRange(12, "ts").sortWithinPartitions(F.xxhash64("event_id")).write.parquet(f"{root}/in")
    in_time_order(spark, f"{root}/in")
    stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    out = counter_rate_stream(stream, ["job", "instance"], "ts", "reading", "event_id", "1 day", "6 hours", "10 minutes")
    return run_available_now(spark, out, f"{root}/out", f"{root}/state")


@register("metric_last", f"""
WITH {_SAMPLES_SQL}
SELECT job, instance, counter AS last, ts AS last_ts FROM c
QUALIFY ROW_NUMBER() OVER (PARTITION BY job, instance ORDER BY ts DESC, event_id DESC) = 1
""")
def metric_last(spark, sf):
    return M.last_value(_counters_only(spark, sf), ["job", "instance"], "ts", "counter", "event_id")


@register("metric_series_count", f"""
WITH {_SAMPLES_SQL}
SELECT step, COUNT(*) AS series FROM (
  SELECT DISTINCT {_STEP_SQL} AS step, job, instance FROM s WHERE NOT regexp_full_match(job, 'err.*')) v
GROUP BY step
""")
def metric_series_count(spark, sf):
    s = match_labels(_samples(spark, sf), [("job", "!~", "err.*")])
    v = M.instant_range(s, ["job", "instance"], "ts", "up", 3600, 3600, "event_id")
    return M.count_series(v, ["step"], "series")


@register("metric_recent_6h", f"""
WITH {_SAMPLES_SQL}
SELECT job, instance, counter AS last, ts AS last_ts FROM c
WHERE ts > (SELECT MAX(ts) FROM events) - INTERVAL 6 HOUR
QUALIFY ROW_NUMBER() OVER (PARTITION BY job, instance ORDER BY ts DESC, event_id DESC) = 1
""")
def metric_recent_6h(spark, sf):
    """The newest counter reading of each series in the last six hours; the counter runs from the first sample on.

    The dashboard's end time is known before the query is planned, so the
    range is a literal that reaches the scan; what the counter holds at the range's
    begin is summed from the whole history before, one row a series.
    """
    events = _t(spark, sf, "events")
    now = events.agg(F.max("ts")).first()[0] or dt.datetime(1970, 1, 1)  # from the files' statistics alone
    s = _samples(spark, sf)
    ensure_checkpoint_dir(spark)
    before = M.increase_before(s, ["job", "instance"], "ts", "inc", now, 6 * 3600).checkpoint()
    return M.last_counter(M.recent(s, "ts", now, 6 * 3600), before, ["job", "instance"], "ts", "inc", "event_id")


@register("stream_rate", _RATE_SQL + """
SELECT window_start, window_end, job, instance, samples, increase,
       CASE WHEN samples >= 2 THEN """ + _rnd('increase / NULLIF(elapsed_s, 0)', 6) + """ END AS rate FROM r
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE - INTERVAL 1 MICROSECOND
""")
def stream_rate(spark, sf):
    """Events as a stream: watermarked sliding-window rate per series, append mode."""
    from rivulet.streaming.rate import run_available_now, windowed_increase
    root = _io_root(spark, "stream_rate")
    out = windowed_increase(fx.metric_samples(fx.event_stream(spark, sf)), ["job", "instance"], "ts", "inc",
                            "event_id", "1 day", "6 hours", "10 minutes")
    return run_available_now(spark, out, f"{root}/out", f"{root}/state")


# ------------------------------------------------------------ silver plans
_AVAIL_SQL = """CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 5 THEN 'Empty'
             ELSE 'In stock (' || CAST(p_size AS VARCHAR) || ' available)' END"""
_REVIEWS_SQL = """CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 4 THEN CAST(p_size AS VARCHAR) || '.0'
             WHEN p_partkey % 9 = 7 THEN 'n/a' WHEN p_partkey % 9 = 5 THEN '1d' ELSE CAST(p_size AS VARCHAR) END"""


def _strict_sql(x: str) -> str:
    t = f"regexp_replace(replace(replace({x}, '£', ''), 'Â', ''), '{_STRIP_RE}', '', 'g')"
    return f"CASE WHEN regexp_matches({t}, '{_FLOAT_RE}') THEN TRY_CAST({t} AS DOUBLE) END"


@register("books_silver_clean", f"""
WITH raw AS (SELECT CAST(p_partkey AS VARCHAR) AS url, p_name AS titre, p_type AS categorie, p_brand AS upc,
                    {_PRICE_TEXT_SQL} AS prix_ttc, {_AVAIL_SQL} AS disponibilite, {_REVIEWS_SQL} AS nombre_davis
             FROM part)
SELECT url, titre, upc, categorie AS category, {_strict_sql('prix_ttc')} AS price_gbp,
       COALESCE(TRY_CAST(regexp_extract(disponibilite, '\\((\\d+)', 1) AS INTEGER), 0) AS stock,
       CASE WHEN regexp_matches(nombre_davis, '^[0-9.]+$') THEN CAST(CAST(nombre_davis AS DOUBLE) AS INTEGER) ELSE 0 END AS reviews,
       {_strict_sql('prix_ttc')} * CAST({_R['EUR']} AS DOUBLE) AS price_eur,
       {_strict_sql('prix_ttc')} * CAST({_R['USD']} AS DOUBLE) AS price_usd
FROM raw
""")
def books_silver_clean(spark, sf):
    p = _t(spark, sf, "part")
    raw = p.select(F.col("p_partkey").cast("string").alias("url"), F.col("p_name").alias("titre"),
                   F.col("p_type").alias("categorie"), F.col("p_brand").alias("upc"),
                   fx.price_text(p).alias("prix_ttc"), fx.availability_text(p).alias("disponibilite"),
                   fx.reviews_text(p).alias("nombre_davis"))
    return books_silver(raw, fx.rates_row(spark))


@register("countries_silver_dedup", f"""
SELECT name, iso3, region, population, area,
       population / NULLIF(area, 0) AS population_density
FROM (SELECT c.c_name AS name, n.n_name AS iso3, r.r_name AS region,
             CASE WHEN c.c_custkey % 7 < 2 THEN NULL ELSE CAST(trunc(c.c_acctbal) AS BIGINT) END AS population,
             CAST(c.c_custkey % 50 AS DOUBLE) AS area,
             ROW_NUMBER() OVER (PARTITION BY n.n_name ORDER BY c.c_custkey) AS rn
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey) t
WHERE rn = 1
""")
def countries_silver_dedup(spark, sf):
    c, n, r = _t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region")
    geo = broadcast_if_small(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name"))
    raw = c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_name").alias("name"), F.col("n_name").alias("iso3"), F.col("r_name").alias("region"),
        F.when(F.col("c_custkey") % 7 == 0, "nan").when(F.col("c_custkey") % 7 == 1, "1d")
         .otherwise(F.col("c_acctbal").cast("string")).alias("population"), (F.col("c_custkey") % 50).alias("area"), "c_custkey")
    out = countries_silver(raw, order_by=["c_custkey"])
    return out.select("name", "iso3", "region", "population", "area", "population_density")


@register("wine_silver_clean", rf"""
SELECT title, country, variety, price, points, price / NULLIF(points, 0) AS price_per_point
FROM (SELECT p_brand AS title, regexp_replace(' ' || p_type || ' ', '{_STRIP_RE}', '', 'g') AS country,
             regexp_replace(p_name || '  ', '{_STRIP_RE}', '', 'g') AS variety,
             CASE WHEN p_partkey % 13 IN (0, 2, 5, 7) THEN NULL ELSE p_retailprice END AS price,
             TRY_CAST(CAST(p_size % 20 AS VARCHAR) AS DOUBLE) AS points,
             ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn
      FROM part) t
WHERE rn = 1 AND price IS NOT NULL AND country IS NOT NULL
""")
def wine_silver_clean(spark, sf):
    p = _t(spark, sf, "part")
    raw = p.select(F.col("p_brand").alias("title"), F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")).alias("country"),
                   F.concat(F.col("p_name"), F.lit("  ")).alias("variety"),
                   F.when(F.col("p_partkey") % 13 == 0, F.lit("n/a")).when(F.col("p_partkey") % 13 == 2, F.lit("nan"))
                    .when(F.col("p_partkey") % 13 == 5, F.lit("1d")).when(F.col("p_partkey") % 13 == 7, F.lit("inf"))
                    .otherwise(F.col("p_retailprice").cast("string")).alias("price"),
                   (F.col("p_size") % 20).cast("string").alias("points"), "p_partkey")
    return wine_silver(raw, order_by=["p_partkey"]).select("title", "country", "variety", "price", "points",
                                                           "price_per_point")


# ------------------------------------------------------- BI over gold tables
def _gold_details(spark, sf):
    return gold_details_converted(spark, sf)


def _enriched(spark, sf):
    return enriched_left_join(spark, sf)


@register("bi_books_by_category", f"""
WITH gold_books_details AS ({ORACLE['gold_details_converted']})
SELECT category, COUNT(*) AS nb FROM gold_books_details GROUP BY category
""")
def bi_books_by_category(spark, sf):
    return BI.books_by_category(_gold_details(spark, sf))


@register("bi_top_priced_books", f"""
WITH gold_books_details AS ({ORACLE['gold_details_converted']})
SELECT titre, price_gbp FROM gold_books_details ORDER BY price_gbp DESC NULLS FIRST, titre LIMIT 10
""")
def bi_top_priced_books(spark, sf):
    return BI.top_priced_books(_gold_details(spark, sf))


@register("bi_stock_total", f"""
WITH gold_books_details AS ({ORACLE['gold_details_converted']})
SELECT CAST(SUM(stock) AS BIGINT) AS stock_total, COUNT(*) AS books FROM gold_books_details
""")
def bi_stock_total(spark, sf):
    return BI.stock_total(_gold_details(spark, sf))


@register("bi_top_populated", f"""
WITH gold_countries_enriched AS ({ORACLE['enriched_left_join']})
SELECT pays, population_banque_mondiale, region FROM gold_countries_enriched
WHERE population_banque_mondiale IS NOT NULL
ORDER BY population_banque_mondiale DESC, pays LIMIT 20
""")
def bi_top_populated(spark, sf):
    return BI.top_populated(_enriched(spark, sf))


@register("bi_rate_by_currency", f"""
WITH gold_countries_enriched AS ({ORACLE['enriched_left_join']})
SELECT devise_principale, {_rnd('AVG(taux_change_vs_gbp)', 6)} AS taux FROM gold_countries_enriched
WHERE taux_change_vs_gbp IS NOT NULL GROUP BY devise_principale
""")
def bi_rate_by_currency(spark, sf):
    return BI.rate_by_currency(_enriched(spark, sf))


@register("bi_countries_by_region", f"""
WITH gold_countries_enriched AS ({ORACLE['enriched_left_join']})
SELECT region, COUNT(*) AS nb_pays FROM gold_countries_enriched GROUP BY region
""")
def bi_countries_by_region(spark, sf):
    return BI.countries_by_region(_enriched(spark, sf))


@register("bi_sql_avg_price_by_category", f"""
WITH gold_books_analytics AS ({ORACLE['gold_category_analytics']})
SELECT categorie, prix_moyen_gbp, prix_moyen_eur, prix_moyen_usd FROM gold_books_analytics
""")
def bi_sql_avg_price_by_category(spark, sf):
    """The SQL-lab form, run through ``spark.sql`` over a temp view of the gold table."""
    return BI.run_sql(spark, "avg_price_by_category", {"gold_books_analytics": gold_category_analytics(spark, sf)})


# ------------------------------------------------- writes read back (sinks)
def _io_root(spark, tag: str) -> str:
    """A fresh folder under this application's folder in the shared checkpoint folder."""
    return f"{own_folder(spark)}/io/{tag}-{uuid.uuid4().hex[:10]}"


@register("versioned_latest", f"""
SELECT o_orderkey, o_custkey, {_rnd('o_totalprice * 1.1')} AS o_totalprice FROM orders
""")
def versioned_latest(spark, sf):
    """Two versions of a table written side by side; the reader sees only the newest."""
    root = _io_root(spark, "versioned")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write_versioned(o, root, "20240101_000000")
    write_versioned(o.withColumn("o_totalprice", round_half_even(F.col("o_totalprice") * 1.1, 2)), root,
                    "20240102_000000")
    return read_latest_version(spark, root).drop("version")


@register("audit_rows", """
SELECT 'lineitem_silver' AS table_name, COUNT(*) AS rows FROM lineitem
UNION ALL
SELECT 'orders_silver' AS table_name, COUNT(*) AS rows FROM orders
""")
def audit_rows(spark, sf):
    """Versioned writes append audit rows whose counts come from the writes themselves."""
    root = _io_root(spark, "audit")
    for name in ("lineitem", "orders"):
        path, rows = write_versioned(_t(spark, sf, name), f"{root}/{name}_silver", "20240101_000000")
        append_audit(spark, f"{root}/audit", f"{name}_silver", rows, path)
    return spark.read.parquet(f"{root}/audit").select("table_name", "rows")


@register("partitioned_roundtrip", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def partitioned_roundtrip(spark, sf):
    """Layer publication partitioned by segment; the read prunes partitions."""
    root = _io_root(spark, "lake")
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path, _ = publish(c, root, "silver", "customers", partition_by=["c_mktsegment"])
    return (spark.read.parquet(path).filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
                 .select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))


@register("csv_roundtrip", f"""
SELECT CAST(p_partkey AS VARCHAR) AS url, p_name AS titre, {_PRICE_TEXT_SQL} AS prix_ttc,
       {_strict_sql(_PRICE_TEXT_SQL)} AS price_gbp
FROM part
""")
def csv_roundtrip(spark, sf):
    """Scraped rows through a CSV file (header, quoting) and back, then price cleaning."""
    root = _io_root(spark, "csv")
    p = _t(spark, sf, "part")
    raw = p.select(F.col("p_partkey").cast("string").alias("url"), F.col("p_name").alias("titre"),
                   fx.price_text(p).alias("prix_ttc"))
    write_csv(raw, root)
    back, _ = csv_rejects(read_csv(spark, root))
    return back.select("url", "titre", "prix_ttc", clean_price_strict("prix_ttc").alias("price_gbp"))


@register("upsert_versioned_load", ORACLE["upsert_orders"])
def upsert_versioned_load(spark, sf):
    """The load step end to end: initial load, then a merge published as a new
    version (duplicate keys refused, load audit appended); read the newest."""
    root = _io_root(spark, "upsert")
    target, updates = _upsert_inputs(spark, sf)
    keys, cols = ["o_orderkey"], ["o_totalprice"]
    upsert_versioned(spark, target, f"{root}/orders", f"{root}/audit", "orders", keys, cols, stamp="20240101_000000")
    upsert_versioned(spark, updates, f"{root}/orders", f"{root}/audit", "orders", keys, cols, stamp="20240102_000000")
    return read_latest_version(spark, f"{root}/orders").drop("version")


@register("stream_counter_rate", ORACLE["stream_rate"])
def stream_counter_rate(spark, sf):
    """Absolute counter readings in one file through the streaming rate of raw
    readings; windows are emitted as the watermark passes them."""
    from rivulet.streaming.rate import counter_rate_stream, run_available_now
    root = _io_root(spark, "counters")
    counters = _counters_only(spark, sf).select("event_id", "ts", "job", "instance", "counter")
    counters.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(counters.schema).parquet(f"{root}/in")
    out = counter_rate_stream(stream, ["job", "instance"], "ts", "counter", "event_id", "1 day", "6 hours", "10 minutes")
    return run_available_now(spark, out, f"{root}/out", f"{root}/state")


@register("metric_instant_at", f"""
WITH {_SAMPLES_SQL},
a AS (SELECT MIN(ts) + INTERVAL 14 DAY AS eval_ts FROM events)
SELECT job, instance, counter FROM c, a
WHERE ts > eval_ts - INTERVAL 1 HOUR AND ts <= eval_ts
QUALIFY ROW_NUMBER() OVER (PARTITION BY job, instance ORDER BY ts DESC, event_id DESC) = 1
""")
def metric_instant_at(spark, sf):
    """Instant vector at one evaluation time (two weeks after the first sample), 1 h lookback."""
    c = _counters_only(spark, sf)
    at = c.select(F.min("ts")).scalar() + F.expr("INTERVAL 14 DAYS")
    return M.instant_at(c, ["job", "instance"], "ts", "counter", at, lookback_seconds=3600, tiebreak="event_id")


@register("metric_up_matched", f"""
WITH {_SAMPLES_SQL},
v AS (SELECT step, job, instance, up FROM (SELECT *, {_STEP_SQL} AS step FROM s
                                           WHERE regexp_full_match(job, 'click|view')) a
      QUALIFY ROW_NUMBER() OVER (PARTITION BY step, job, instance ORDER BY ts DESC, event_id DESC) = 1)
SELECT step, CAST(SUM(up) AS BIGINT) AS up FROM v GROUP BY step
""")
def metric_up_matched(spark, sf):
    """``sum(up{{job=~"click|view"}})`` per hourly step."""
    s = match_labels(_samples(spark, sf), [("job", "=~", "click|view")])
    v = M.instant_range(s, ["job", "instance"], "ts", "up", 3600, 3600, "event_id")
    return v.groupBy("step").agg(F.sum("up").alias("up"))


@register("stream_sum_rate", _RATE_SQL + """
SELECT window_start, window_end, job, """ + _rnd('SUM(rate)', 6) + """ AS rate FROM (
  SELECT window_start, window_end, job, CASE WHEN samples >= 2 THEN """ + _rnd('increase / NULLIF(elapsed_s, 0)', 6) + """ END AS rate
  FROM r) q
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE - INTERVAL 1 MICROSECOND
GROUP BY window_start, window_end, job
""")
def stream_sum_rate(spark, sf):
    """Streaming ``sum(rate()) by (job)``: two chained windowed aggregations, append mode."""
    from rivulet.streaming.rate import run_available_now, windowed_rate_sum
    root = _io_root(spark, "stream_sum_rate")
    out = windowed_rate_sum(fx.metric_samples(fx.event_stream(spark, sf)), ["job", "instance"], ["job"], "ts",
                            "inc", "event_id", "1 day", "6 hours", "10 minutes")
    return run_available_now(spark, out, f"{root}/out", f"{root}/state")


@register("stream_instant", f"""
WITH {_SAMPLES_SQL}
SELECT step, job, instance, up FROM (SELECT *, {_STEP_SQL} AS step FROM s) a
WHERE step <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE - INTERVAL 1 MICROSECOND
QUALIFY ROW_NUMBER() OVER (PARTITION BY step, job, instance ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_instant(spark, sf):
    """Streaming ``up`` gauge per hourly step (lookback one step), append mode."""
    from rivulet.streaming.rate import instant_steps, run_available_now
    root = _io_root(spark, "instant")
    out = instant_steps(fx.metric_samples(fx.event_stream(spark, sf)), ["job", "instance"], "ts", "up", "event_id",
                        "1 hour", "10 minutes")
    return run_available_now(spark, out, f"{root}/out", f"{root}/state")


@register("metric_rate_5m", _rate_sql(5, 1) + """
SELECT window_start, window_end, job, instance, samples, increase,
       CASE WHEN samples >= 2 THEN """ + _rnd('increase / NULLIF(elapsed_s, 0)', 6) + """ END AS rate FROM r
""")
def metric_rate_5m(spark, sf):
    """The dashboards' ``rate(counter[5m])``, evaluated every minute (sparse events: many
    windows hold one sample and have no rate)."""
    return M.counter_rate_from_increments(_samples(spark, sf), ["job", "instance"], "ts", "inc", "event_id",
                                          window="5 minutes", slide="1 minute")


# further queries register themselves; they use the helpers above
from rivulet import catalog_bi, catalog_sources  # noqa: E402, F401
