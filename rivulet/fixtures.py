"""Shape the driver's tables into the reference's source tables.

Every derived value is a deterministic rule over the input rows, written once
here and once as SQL in the oracle (``rivulet.catalog``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.joins import broadcast_if_small

# --- fixed values: exchange-rate row used by the fixture queries -----------
RATES = {"USD": 1.27, "EUR": 1.17, "ZAR": 23.5, "NGN": 1650.0, "KES": 164.0, "EGP": 61.5}
RATES_BASE = "GBP"
RATES_DATE = "2024-01-31"
# Currency code list of a nation, by nation key modulo 9 (None: no currencies).
NATION_CURRENCIES = ["USD, EUR", "EUR", "ZAR", "NGN, USD", "KES", "EGP", "GBP", "", None]
# Languages of a nation, by nation key modulo 3.
NATION_LANGUAGES = [{"eng": "English", "fra": "French"}, {"swa": "Swahili"}, None]
LINK_BASE = "https://books.example/catalogue/"
# ---------------------------------------------------------------------------


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rates_row(spark: SparkSession) -> DataFrame:
    """The wide one-row rate table (planned as a JVM-side one-row relation)."""
    return spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in RATES.items()],
                                 F.lit(RATES_BASE).alias("base"), F.lit(RATES_DATE).alias("date"))


def _pick(key: Column, values: list, modulo: int) -> Column:
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if not isinstance(v, dict) else (
            F.create_map(*[F.lit(x) for kv in v.items() for x in kv]) if v else None)
        if lit is None:
            continue
        cond = (key % modulo) == i
        expr = F.when(cond, lit) if expr is None else expr.when(cond, lit)
    return expr


def currency_codes(nationkey: Column) -> Column:
    return _pick(nationkey, NATION_CURRENCIES, len(NATION_CURRENCIES))


def languages(nationkey: Column) -> Column:
    return _pick(nationkey, NATION_LANGUAGES, len(NATION_LANGUAGES))


def books_silver_from_part(part: DataFrame) -> DataFrame:
    """Book-catalogue silver rows: one per part."""
    return part.select(
        F.col("p_partkey").alias("upc"), F.col("p_name").alias("titre"), F.col("p_type").alias("category"),
        F.when(F.col("p_partkey") % 43 == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice")).alias("price_gbp"),
        F.col("p_size").alias("stock"),
        (F.col("p_partkey") % 6).alias("reviews"))


def price_text(part: DataFrame) -> Column:
    """Scraped-looking price text with the malformed variants mixed in."""
    k = F.col("p_partkey")
    money = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    return (F.when(k % 29 == 0, F.lit(None).cast("string"))
             .when(k % 23 == 0, F.lit("1d"))
             .when(k % 19 == 0, F.lit("1.2.3"))
             .when(k % 17 == 0, F.lit("-5.00"))
             .when(k % 13 == 0, F.lit("."))
             .when(k % 11 == 0, F.concat(F.lit("Â£"), money))
             .when(k % 7 == 0, F.lit("invalid"))
             .when(k % 31 == 0, F.lit("nan"))
             .when(k % 37 == 0, F.lit("£inf"))
             .when(k % 41 == 0, F.lit(" 12.5e1 "))
             .otherwise(F.concat(F.lit("£"), money)))


def availability_text(part: DataFrame) -> Column:
    k = F.col("p_partkey")
    return (F.when(k % 10 == 0, F.lit(None).cast("string"))
             .when(k % 10 == 5, F.lit("Empty"))
             .otherwise(F.concat(F.lit("In stock ("), F.col("p_size").cast("string"), F.lit(" available)"))))


def reviews_text(part: DataFrame) -> Column:
    k = F.col("p_partkey")
    s = F.col("p_size").cast("string")
    return (F.when(k % 9 == 0, F.lit(None).cast("string"))
             .when(k % 9 == 4, F.concat(s, F.lit(".0")))
             .when(k % 9 == 7, F.lit("n/a"))
             .when(k % 9 == 5, F.lit("1d"))
             .otherwise(s))


def _geo(nation: DataFrame, region: DataFrame) -> DataFrame:
    """nation + region names; broadcast after one bounded size check."""
    r = region.select("r_regionkey", "r_name")
    geo = nation.join(r, nation.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return broadcast_if_small(geo, 100_000)


def countries_from_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Country-shaped rows: one per customer, with its nation and region."""
    c = customer.join(_geo(nation, region), customer.c_nationkey == F.col("n_nationkey"))
    return c.select(
        F.col("c_name").alias("name"), F.upper("c_name").alias("official_name"),
        F.col("r_name").alias("region"), F.col("n_name").alias("subregion"),
        F.col("c_acctbal").alias("population"), F.col("c_nationkey").alias("area"),
        F.col("n_name").alias("capital"), currency_codes(F.col("n_nationkey")).alias("currency_codes"),
        F.col("c_custkey").alias("iso2"), F.col("c_name").alias("iso3"))


def population_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_custkey").alias("country_iso2"),
                         F.col("o_orderdate").cast("date").alias("year"),
                         F.col("o_totalprice").alias("population"))


def country_payloads(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Countries-API JSON documents, each an array of up to five countries (customers)."""
    c = customer.join(_geo(nation, region), customer.c_nationkey == F.col("n_nationkey"))
    codes = F.filter(F.split(currency_codes(F.col("n_nationkey")), ", "), lambda x: x != "")
    currencies = F.map_from_arrays(codes, F.transform(codes, lambda x: F.struct(F.concat(x, F.lit(" money")).alias("name"))))
    country = F.struct(
        F.struct(F.col("c_name").alias("common"), F.upper("c_name").alias("official")).alias("name"),
        F.when(F.col("c_custkey") % 5 == 0, F.array().cast("array<string>"))
         .otherwise(F.array(F.col("n_name"))).alias("capital"),
        F.col("r_name").alias("region"), F.col("n_name").alias("subregion"),
        F.col("c_custkey").cast("string").alias("cca2"), F.col("c_name").alias("cca3"),
        (F.col("c_custkey") * 1000).alias("population"), F.col("c_acctbal").alias("area"),
        languages(F.col("n_nationkey")).alias("languages"),
        currencies.alias("currencies"))
    return (c.groupBy(F.floor(F.col("c_custkey") / 5).alias("payload_id"))
            .agg(F.to_json(F.collect_list(country)).alias("payload")))


def broken_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads of which some are cut off, error objects, of another type, or missing (by payload id modulo 7)."""
    k = F.col("payload_id") % 7
    return payloads.withColumn("payload", F.when(k == 0, F.expr("left(payload, length(payload) - 5)"))
                               .when(k == 1, F.lit('{"status":500,"message":"try again"}'))
                               .when(k == 2, F.lit('[{"name":{"common":"x"},"capital":"text"}]'))
                               .when(k == 3, F.lit(None).cast("string")).otherwise(F.col("payload")))


def product_pages(part: DataFrame) -> DataFrame:
    """Product pages of the book site, one per part, in varying markup; some without the main block."""
    k, name = F.col("p_partkey"), F.regexp_replace("p_name", "&", "&amp;")
    q = F.when(k % 3 == 0, F.lit("'")).otherwise(F.lit('"'))
    row = lambda head, cell: F.concat(F.lit(f"<tr><th>{head}</th><td>"), cell, F.lit("</td></tr>"))
    money = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    main = F.when(k % 11 == 0, F.lit("other")).otherwise(F.lit("col-sm-6 product_main"))
    crumbs = F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("<li><a>"), F.col("p_type"), F.lit("</a></li>")))
    html = F.concat(
        F.lit('<html><script>var x = "</ul>";</script><ul class="breadcrumb"><li>Home</li><li>Books</li>'), crumbs, F.lit("</ul>"),
        F.lit("<div class="), q, F.lit("item active"), q, F.lit("><img src="), q, F.lit("../../media/"), k.cast("string"),
        F.lit(".jpg?a=1&amp;b=2"), q, F.lit("></div>"),
        F.lit("<div class="), q, main, q, F.lit("><h1>"), name, F.lit(" &eacute;&#8217;s</h1></div>"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(
            F.lit("<div id="), q, F.lit("product_description"), q, F.lit("><h2>About</h2></div><p>A "), F.col("p_brand"), F.lit(" &lt;book&gt;</p>"))),
        F.lit("<table>"), row("UPC", k.cast("string")), row("Product Type", F.lit("Books")),
        row("Price (excl. tax)", F.concat(F.lit("&pound;"), money)), row("Price (incl. tax)", F.concat(F.lit("£"), money)),
        row("Availability", F.concat(F.lit("In stock ("), F.col("p_size").cast("string"), F.lit(" available)"))),
        F.when(k % 6 == 0, F.lit("")).otherwise(row("Number of reviews", (k % 6).cast("string"))), F.lit("</table></html>"))
    return part.select(F.concat(F.lit("page/"), k.cast("string")).alias("url"), html.alias("html"))


def nested_pages(part: DataFrame) -> DataFrame:
    """Pages with boxes inside boxes, and links inside and outside of articles."""
    k, name = F.col("p_partkey"), F.regexp_replace("p_name", "&", "&amp;")
    inner = F.concat(F.lit("<div"), F.when(k % 3 == 0, "").otherwise(" class='x box'"), F.lit(">in "), name, F.lit(" <div>deep"),
                     F.col("p_size").cast("string"), F.lit("</div></div>"))
    link = F.when(k % 4 == 0, F.lit("sold out")).otherwise(F.concat(F.lit("<a href='l"), k.cast("string"), F.lit("'>t</a>")))
    return part.select("p_partkey", F.concat(F.lit("<div class='box'>"), inner, F.lit(" tail</div><article class='pod'><h3>"), link,
                                             F.lit("</h3></article><a href='ad'>ad</a><article class='pods'><h3><a href='no'>n</a></h3></article>")).alias("html"))


def catalogue_pages(part: DataFrame) -> DataFrame:
    """Catalogue pages of the book site with up to twenty product links, quoted in all three ways."""
    k = F.col("p_partkey").cast("string")
    path = F.concat(F.lit("../../book_"), k, F.lit("/index.html"))
    href = (F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("'"), path, F.lit("'")))
             .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit('"'), path, F.lit('"'))).otherwise(path))
    pod = F.concat(F.lit('<article class="product_pod"><a href="#x">pic</a><h3><a title="t" href='), href, F.lit(">t</a></h3></article>"))
    return (part.groupBy(F.floor(F.col("p_partkey") / 20).alias("page_id"))
            .agg(F.concat(F.lit("<html><!-- <h3> -->"), F.array_join(F.collect_list(pod), ""), F.lit("</html>")).alias("html")))


def population_pages(orders: DataFrame) -> DataFrame:
    """Two-part population pages ``[metadata, [observation, ...]]`` of up to a hundred orders."""
    meta = F.to_json(F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"),
                              F.lit(1).alias("per_page"), F.lit(1).alias("total")))
    obs = F.struct(
        F.struct(F.lit("SP.POP.TOTL").alias("id"), F.lit("Population, total").alias("value")).alias("indicator"),
        F.struct(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderpriority").alias("value")).alias("country"),
        F.when(F.col("o_orderstatus") == "F", F.lit("n/a"))
         .otherwise(F.year("o_orderdate").cast("string")).alias("date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("value"))
    return (orders.groupBy(F.floor(F.col("o_orderkey") / 100).alias("page_id"))
            .agg(F.concat(F.lit("["), meta, F.lit(","), F.to_json(F.collect_list(obs)), F.lit("]")).alias("payload")))


def rate_payloads(events: DataFrame) -> DataFrame:
    """One exchange-rate JSON document per event day (values from that day's events)."""
    day = F.date_format(F.col("ts"), "yyyy-MM-dd")
    g = events.groupBy(day.alias("date")).agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                              F.count(F.lit(1)).cast("double").alias("n"))
    rates = F.create_map(F.lit("USD"), F.col("lo"), F.lit("JPY"), F.col("hi") * 2,
                         F.lit("EUR"), F.col("hi"), F.lit("ZAR"), F.col("n"))
    return g.select(F.to_json(F.struct(F.lit("GBP").alias("base"), F.col("date"), rates.alias("rates"))).alias("payload"))


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table of ``sf_dir`` read as a file stream."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir)


#: The jobs that report samples (the kinds of events).
EVENT_JOBS = ["click", "error", "purchase", "signup", "view"]


def metric_samples(events: DataFrame) -> DataFrame:
    """Metric samples from events: one counter series per (job, instance).

    ``inc`` is the event value in integer cents, so counters are exact.
    """
    job = F.coalesce(F.col("event_type"), F.lit(""))  # a missing label is ''
    inst = F.coalesce((F.col("user_id") % 4).cast("string"), F.lit(""))
    return events.select(
        "event_id", "ts", job.alias("job"), inst.alias("instance"),
        F.create_map(F.lit("job"), job, F.lit("instance"), inst).alias("labels"),
        F.col("value"), F.round(F.col("value") * 100).cast("long").alias("inc"),
        F.when(F.col("value") >= 10, 1).otherwise(0).alias("up"))
