"""Registered queries of sources, sinks, page parsers, rejects and constraints on inputs that break the rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rivulet import fixtures as fx
from rivulet.catalog import ORACLE, _R, _io_root, _rnd, _t, _upsert_inputs, in_time_order, register
from rivulet.functions.clean import clean_availability, version_stamp
from rivulet.operators.dedup import dedup_file_order, tasks_for
from rivulet.operators.elements import select, spread
from rivulet.operators.filters import is_empty
from rivulet.operators.flatten import flatten_rates, split_countries, split_observations, split_rates
from rivulet.operators.joins import latest_per_key
from rivulet.operators.keys import dense_ids, extend_ids
from rivulet.operators.quality import duplicate_keys, fk_summary, null_violations, orphans
from rivulet.plans.books import book_links, book_records, gold_books_details
from rivulet.plans.countries import gold_countries_enriched
from rivulet.plans.load import load_incremental, load_newest, read_partitions, upsert_partitions
from rivulet.plans.silver import rates_silver
from rivulet.session import ship_package
from rivulet.sinks.files import write, write_csv, write_json, write_stream_audited, write_text
from rivulet.sources.files import (
    csv_rejects, is_complete_path, is_fresh_path, read_csv, read_first_available, read_latest_version, read_lines, read_newest_dataset,
)

# --------------------------------------------------------------- product pages
_BOOK_SQL = """
SELECT 'page/' || p_partkey AS url, replace(p_name, '&amp;', '&') || ' é’s' AS titre,
       CASE WHEN p_partkey % 4 = 0 THEN 'Books' ELSE p_type END AS categorie,
       CASE WHEN p_partkey % 5 <> 0 THEN 'A ' || p_brand || ' <book>' END AS description,
       CAST(p_partkey AS VARCHAR) AS upc, 'Books' AS type_produit,
       '£' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS prix_hors_taxe,
       '£' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS prix_ttc,
       'In stock (' || p_size || ' available)' AS disponibilite,
       CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_partkey % 6 AS VARCHAR) END AS nombre_davis,
       'https://books.toscrape.com/media/' || p_partkey || '.jpg?a=1&b=2' AS image_url
FROM part WHERE p_partkey % 11 <> 0
"""


@register("html_book_records", _BOOK_SQL)
def html_book_records(spark, sf):
    """Product pages in varying markup -> raw book rows; pages without the main block are rejected."""
    return book_records(fx.product_pages(_t(spark, sf, "part")))[0]


@register("html_book_rejects", """
SELECT 'page/' || p_partkey AS url, 'invalid page structure: no product_main block' AS reject_reason FROM part WHERE p_partkey % 11 = 0
""")
def html_book_rejects(spark, sf):
    return book_records(fx.product_pages(_t(spark, sf, "part")))[1]


@register("html_product_links", """
SELECT 'https://books.toscrape.com/catalogue/book_' || p_partkey || '/index.html' AS url FROM part
""")
def html_product_links(spark, sf):
    """Catalogue pages with links in double quotes, single quotes and none."""
    return book_links(fx.catalogue_pages(_t(spark, sf, "part")))


@register("html_nested", """
SELECT p_partkey, 'in ' || p_name || ' deep' || p_size || ' tail' AS first_box,
       CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 2 END AS boxes, CASE WHEN p_partkey % 4 <> 0 THEN 'l' || p_partkey END AS link FROM part
""")
def html_nested(spark, sf):
    """Boxes inside boxes of the same tag, and articles with and without a link before one that is an advertisement."""
    page = spread(fx.nested_pages(_t(spark, sf, "part")))
    ship_package(spark)
    found = page.select("p_partkey", select(F.col("html"), {"box": ("div.box", "text"), "href": ("article.pod h3 a", "@href")}).alias("s"))
    return found.select("p_partkey", F.get("s.box", 0).alias("first_box"), F.size("s.box").alias("boxes"), F.get("s.href", 0).alias("link"))


# --------------------------------------------------------------------- rejects
@register("json_rejects", """
SELECT 'countries' AS source, CAST(payload_id AS VARCHAR) AS payload_id,
       CASE WHEN payload_id % 7 = 3 THEN 'missing payload' ELSE 'malformed or of another shape' END AS reject_reason
FROM (SELECT DISTINCT c_custkey // 5 AS payload_id FROM customer) c WHERE payload_id % 7 < 4
UNION ALL
SELECT 'pages', CAST(payload_id AS VARCHAR),
       CASE payload_id % 7 WHEN 3 THEN 'missing payload' WHEN 0 THEN 'malformed' ELSE 'no list of observations' END
FROM (SELECT DISTINCT o_orderkey // 100 AS payload_id FROM orders) o WHERE payload_id % 7 < 4
UNION ALL
SELECT 'rates', d, CASE WHEN n % 2 = 0 THEN 'malformed or of another shape' ELSE 'no rates' END
FROM (SELECT strftime(ts, '%Y-%m-%d') AS d, COUNT(*) AS n FROM events GROUP BY 1) e
""")
def json_rejects(spark, sf):
    """Cut-off, error, mistyped and missing payloads of all three sources, each with its reason."""
    countries = fx.broken_payloads(fx.country_payloads(_t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region")))
    pages = fx.broken_payloads(fx.population_pages(_t(spark, sf, "orders")).withColumnRenamed("page_id", "payload_id"))
    days = _t(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("payload_id")).agg(F.count(F.lit(1)).alias("n"))
    rates = days.withColumn("payload", F.when(F.col("n") % 2 == 0, '{"base":"GBP","rates":{"USD":"x"}}').otherwise('{"base":"GBP","rates":{}}'))
    out = None
    for source, bad in (("countries", split_countries(countries)[1]), ("pages", split_observations(pages)[1]), ("rates", split_rates(rates)[1])):
        part = bad.select(F.lit(source).alias("source"), F.col("payload_id").cast("string").alias("payload_id"), "reject_reason")
        out = part if out is None else out.union(part)
    return out


@register("csv_rejects", """
SELECT CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 9 = 0 THEN '' ELSE ',x,y' END AS line FROM part WHERE p_partkey % 9 < 2
""")
def q_csv_rejects(spark, sf):
    """Lines with too few or too many fields come back as rejects, none is cut or padded."""
    root = _io_root(spark, "csv-odd")
    k = F.col("p_partkey").cast("string")
    line = F.when(F.col("p_partkey") % 9 == 0, k).when(F.col("p_partkey") % 9 == 1, F.concat(k, F.lit(",x,y"))).otherwise(F.concat(k, F.lit(",x")))
    write_text(_t(spark, sf, "part").select(line.alias("l")), root, "l")
    return csv_rejects(read_csv(spark, root, "id string, v string", header="false"))[1].select(F.col("_corrupt_record").alias("line"))


# -------------------------------------------------------------- sources, sinks
@register("newest_dataset", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 1")
def newest_dataset_of_two(spark, sf):
    """Two loads of several part files each: all rows of the newest, none of the other."""
    root = _io_root(spark, "newest")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    write(o.filter("o_orderkey % 2 = 0").repartition(4), f"{root}/load1")
    write(o.filter("o_orderkey % 2 = 1").repartition(4), f"{root}/load2")
    return read_newest_dataset(spark, root)


@register("load_newest_upsert", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS load, CAST(o_custkey AS BIGINT) AS o_custkey FROM orders
""")
def load_newest_upsert(spark, sf):
    """The load step twice: newest dataset -> upsert -> audit."""
    root = _io_root(spark, "load")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    for i, (name, part) in enumerate((("first", o), ("second", o.filter("o_orderkey % 2 = 0")))):
        write(part.withColumn("load", F.lit(name)).repartition(3), f"{root}/raw/{name}")
        load_newest(spark, f"{root}/raw", f"{root}/table", f"{root}/audit", "orders", ["o_orderkey"], ["load"], stamp=f"2024010{i + 1}_000000")
    return read_latest_version(spark, f"{root}/table").select("o_orderkey", "load", "o_custkey")


@register("text_json_roundtrip", "SELECT 'json' AS form, p_name AS value FROM part UNION ALL SELECT 'text', p_name FROM part")
def text_json_roundtrip(spark, sf):
    """Names through a JSON file and through text lines with blanks around them."""
    root = _io_root(spark, "forms")
    p = _t(spark, sf, "part")
    write_json(p.select("p_name"), f"{root}/json")
    write_text(p.select(F.concat(F.lit("  "), "p_name", F.lit("\t")).alias("l")).union(p.select(F.lit(" ").alias("l")).limit(5)), f"{root}/text", "l")
    return (spark.read.schema("p_name string").json(f"{root}/json").select(F.lit("json").alias("form"), F.col("p_name").alias("value"))
            .union(read_lines(spark, f"{root}/text").select(F.lit("text"), "line")))


@register("fallback_and_gates", """
SELECT p_partkey, p_name || chr(10) || 'second "line", of ' || p_brand AS description, TRUE AS complete, FALSE AS too_small, FALSE AS stale, TRUE AS fresh
FROM part
""")
def fallback_and_gates(spark, sf):
    """The silver CSV stands in for a missing gold table, its texts with line breaks and quotes whole; gates on its folder."""
    root = _io_root(spark, "fallback")
    text = F.concat("p_name", F.lit('\nsecond "line", of '), "p_brand").alias("description")
    write_csv(_t(spark, sf, "part").select("p_partkey", text), f"{root}/silver")
    df = read_first_available(spark, [(f"{root}/gold", "parquet"), (f"{root}/silver", "csv")])
    today = dt.datetime.now(dt.timezone.utc).date()
    gates = (("complete", is_complete_path(spark, f"{root}/silver", 10)), ("too_small", is_complete_path(spark, f"{root}/silver", 10 ** 12)),
             ("stale", is_fresh_path(spark, f"{root}/silver", "2000-01-01")),
             ("fresh", is_fresh_path(spark, f"{root}/silver", today) or is_fresh_path(spark, f"{root}/silver", dt.datetime.now(dt.timezone.utc).date())))
    return df.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "description", *[F.lit(v).alias(n) for n, v in gates])


@register("csv_open_quotes", '''
SELECT CASE p_partkey % 5 WHEN 0 THEN CAST(p_partkey AS VARCHAR) || ',"cut ' || p_name ELSE CAST(p_partkey AS VARCHAR) || ',"whole ""' || p_name || '"""' END AS line,
       p_partkey % 5 = 0 AS rejected
FROM part
''')
def csv_open_quotes(spark, sf):
    """Lines that leave a quote open are rejected with their text when files are split by lines, never cut."""
    root = _io_root(spark, "csv-open")
    k, name = F.col("p_partkey").cast("string"), F.col("p_name")
    line = F.when(F.col("p_partkey") % 5 == 0, F.concat(k, F.lit(',"cut '), name)).otherwise(F.concat(k, F.lit(',"whole ""'), name, F.lit('"""')))
    write_text(_t(spark, sf, "part").select(line.alias("l")), root, "l")
    good, bad = csv_rejects(read_csv(spark, root, "id string, v string", header="false"))
    again = F.concat("id", F.lit(',"'), F.replace("v", F.lit('"'), F.lit('""')), F.lit('"'))
    return good.select(again.alias("line"), F.lit(False).alias("rejected")).union(bad.select("_corrupt_record", F.lit(True)))


# ---------------------------------------------------------- joins and columns
@register("latest_per_key_join", """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
JOIN (SELECT o_custkey AS k, MAX(CAST(o_orderdate AS DATE)) AS latest FROM orders GROUP BY o_custkey) m
  ON o_custkey = k AND CAST(o_orderdate AS DATE) = latest
""")
def latest_per_key_join(spark, sf):
    """Latest per key as a grouped maximum joined back on two keys."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return latest_per_key(o, "o_custkey", "day", strategy="join")


@register("enriched_without_sources", """
SELECT c_name AS pays, c_custkey AS iso2, CAST(NULL AS DOUBLE) AS population_banque_mondiale, CAST(NULL AS INTEGER) AS annee_population,
       CAST(NULL AS VARCHAR) AS devise_principale, CAST(NULL AS DOUBLE) AS taux_change_vs_gbp
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def enriched_without_sources(spark, sf):
    """Population and rates missing: typed null columns."""
    countries = fx.countries_from_customers(_t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region"))
    return gold_countries_enriched(countries).select(
        "pays", "iso2", "population_banque_mondiale", "annee_population", "devise_principale", "taux_change_vs_gbp")


@register("tied_rate_rows", f"""
SELECT p_partkey AS upc, {_rnd(f"p_retailprice * CAST({_R['EUR']} AS DOUBLE)")} AS price_eur,
       {_rnd(f"p_retailprice * CAST({_R['USD']} AS DOUBLE)")} AS price_usd FROM part
""")
def tied_rate_rows(spark, sf):
    """Several rate rows of one date, and an older one: all rates come from one row, the same on every run."""
    row = fx.rates_row(spark)
    later = row.withColumns({"EUR": F.col("EUR") + 5, "USD": F.col("USD") + 5})
    older = row.withColumns({"EUR": F.col("EUR") - 1, "USD": F.col("USD") - 1, "date": F.lit("2023-01-01")})
    rates = later.union(older).union(row).repartition(3)
    silver = _t(spark, sf, "part").select(F.col("p_partkey").alias("upc"), F.col("p_retailprice").alias("price_gbp"))
    return gold_books_details(silver, rates).select("upc", "price_eur", "price_usd")


@register("availability_null_default", """
SELECT p_partkey, CASE WHEN p_partkey % 10 NOT IN (0, 5) THEN CAST(p_size AS INTEGER) END AS stock FROM part
""")
def availability_null_default(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", clean_availability(fx.availability_text(p), None).alias("stock"))


@register("rates_silver_stamped", """
SELECT MIN(value) AS USD, MAX(value) AS EUR, strftime(ts, '%Y-%m-%d') AS date, TIMESTAMP '2024-01-31 12:30:45' AS processed_at,
       '20240131_123045' AS version FROM events GROUP BY strftime(ts, '%Y-%m-%d')
""")
def rates_silver_stamped(spark, sf):
    """Rate silver of every payload with a given processing time, and its version stamp."""
    silver = rates_silver(flatten_rates(fx.rate_payloads(_t(spark, sf, "events"))), "2024-01-31 12:30:45")
    return silver.select("USD", "EUR", "date", "processed_at", version_stamp("processed_at").alias("version"))


# ---------------------------------------------------------------- constraints
@register("check_fk_violations", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 50 = 7
""")
def check_fk_violations(spark, sf):
    """Line items whose order is missing (orders with key % 50 = 7 taken away)."""
    parent = _t(spark, sf, "orders").filter("o_orderkey % 50 <> 7")
    return orphans(_t(spark, sf, "lineitem"), parent, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@register("check_fk_counts", "SELECT COUNT(*) AS checked, COUNT(*) FILTER (WHERE l_orderkey % 50 = 7) AS orphans FROM lineitem")
def check_fk_counts(spark, sf):
    parent = _t(spark, sf, "orders").filter("o_orderkey % 50 <> 7")
    return fk_summary(_t(spark, sf, "lineitem"), parent, "l_orderkey", "o_orderkey")


@register("check_not_null_violations", "SELECT c_custkey FROM customer WHERE c_custkey % 13 IN (0, 1)")
def check_not_null_violations(spark, sf):
    k = F.col("c_custkey") % 13
    c = _t(spark, sf, "customer").select("c_custkey", F.when(k != 0, F.col("c_name")).alias("name"), F.when(k != 1, F.col("c_name")).alias("code"))
    return null_violations(c, ["name", "code"]).select("c_custkey")


@register("check_unique_nulls", """
SELECT key, COUNT(*) AS n FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS key FROM orders) o
WHERE key IS NOT NULL GROUP BY key HAVING COUNT(*) > 1
""")
def check_unique_nulls(spark, sf):
    """UNIQUE: rows with a null key never repeat."""
    o = _t(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("key"))
    return duplicate_keys(o, ["key"], nulls_distinct=True)


@register("surrogate_keys_extended", """
WITH old AS (SELECT DENSE_RANK() OVER (ORDER BY p_brand) AS id, p_brand FROM (SELECT DISTINCT p_brand FROM part WHERE p_partkey % 40 = 0) b),
new AS (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL AND p_brand NOT IN (SELECT p_brand FROM old))
SELECT id, p_brand FROM old UNION ALL
SELECT (SELECT COALESCE(MAX(id), 0) FROM old) + DENSE_RANK() OVER (ORDER BY p_brand), p_brand FROM new
""")
def surrogate_keys_extended(spark, sf):
    """A second load adds brands: known ones keep their ids, new ones follow."""
    p = _t(spark, sf, "part")
    return extend_ids(dense_ids(p.filter("p_partkey % 40 = 0"), "p_brand", "id"), p, "p_brand", "id")


@register("upsert_bucketed_load", ORACLE["upsert_orders"])
def upsert_bucketed_load(spark, sf):
    """The same two loads into a table partitioned by a hash of the key: only touched partitions are written again."""
    root = _io_root(spark, "parts")
    target, updates = _upsert_inputs(spark, sf)
    for name, batch in (("first", target), ("second", updates)):
        upsert_partitions(spark, batch, f"{root}/table", ["o_orderkey"], ["o_totalprice"], f"{root}/staging/{name}", parts=16)
    return read_partitions(spark, f"{root}/table")


@register("load_incremental", """
SELECT 'table' AS part, o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'third' WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS v FROM orders
UNION ALL SELECT 'audit', (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM orders WHERE o_orderkey % 2 = 0)
                          + (SELECT COUNT(*) FROM orders WHERE o_orderkey % 3 = 0), '3'
""")
def load_incremental_three(spark, sf):
    """Three files arrive between four calls of the load; a call without a new file adds nothing, newer rows win."""
    root = _io_root(spark, "incremental")
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    audit = None
    for i, (name, rows) in enumerate((("first", o), ("second", o.filter("k % 2 = 0")), ("third", o.filter("k % 3 = 0")), (None, None))):
        if name:
            write(rows.withColumn("v", F.lit(name)).coalesce(1), f"{root}/raw/{i}-{name}")
        audit = load_incremental(spark, f"{root}/raw", "k bigint, v string", f"{root}/table", f"{root}/audit", f"{root}/state", "orders",
                                 ["k"], ["v"], parts=8)
    total = audit.agg(F.sum("rows_loaded").alias("k"), F.count("*").cast("string").alias("v"))
    return read_partitions(spark, f"{root}/table").select(F.lit("table").alias("part"), "k", "v").union(total.select(F.lit("audit"), "k", "v"))


@register("stream_audit", """
SELECT 'lines' AS table_name, CAST(4 AS BIGINT) AS batches, COUNT(*) AS audited, COUNT(*) AS rows_written, SUM(l_quantity) AS quantity FROM lineitem
""")
def stream_audit(spark, sf):
    """Line items streamed in four micro-batches: the audit rows, counted during the writes, add up to what was written."""
    root = _io_root(spark, "stream-audit")
    lines = _t(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    write(lines.repartition(4), f"{root}/in")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    audit = write_stream_audited(stream, f"{root}/out", f"{root}/audit", "lines", f"{root}/state")
    written = spark.read.parquet(f"{root}/out")
    counts = audit.filter("rows > 0").groupBy("table_name").agg(F.count("*").alias("batches"), F.sum("rows").alias("audited"))
    return counts.select("*", written.select(F.count("*")).scalar().alias("rows_written"), written.select(F.sum("l_quantity")).scalar().alias("quantity"))


@register("dedup_file_order", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 7, o_orderkey DESC) = 1
""")
def q_dedup_file_order(spark, sf):
    """The first order of each customer as it stands in several part files, whatever tasks read them."""
    root = _io_root(spark, "file-order")
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", (F.col("o_orderkey") % 7).alias("r"))
    files = max(5, tasks_for(o.count()))  # as many part files as keep a task's sort small
    write(o.repartitionByRange(files, "r", F.desc("o_orderkey")).sortWithinPartitions("r", F.desc("o_orderkey")).drop("r"), root)
    return dedup_file_order(spark.read.parquet(root), ["o_custkey"])


@register("write_by_format", "SELECT 'json' AS fmt, p_name, p_size FROM part UNION ALL SELECT 'orc', p_name, p_size FROM part UNION ALL SELECT 'parquet', p_name, p_size FROM part")
def write_by_format(spark, sf):
    """One table overwritten under each format's name and read back; an empty write leaves it alone."""
    root = _io_root(spark, "formats")
    p = _t(spark, sf, "part").select("p_name", "p_size")
    out = None
    for fmt in ("json", "orc", "parquet"):
        write(p.limit(3), f"{root}/{fmt}", fmt)
        write(p, f"{root}/{fmt}", fmt)
        write(p.filter("false"), f"{root}/{fmt}", fmt, skip_empty=True)
        back = spark.read.format(fmt).schema("p_name string, p_size int").load(f"{root}/{fmt}").select(F.lit(fmt).alias("fmt"), "p_name", "p_size")
        out = back if out is None else out.union(back)
    return out


@register("empty_input_skipped", "SELECT c_mktsegment, COUNT(*) AS n, TRUE AS empty_skipped FROM customer GROUP BY c_mktsegment")
def empty_input_skipped(spark, sf):
    """An empty batch writes nothing over the table that is there, and is told apart from one with rows."""
    root = _io_root(spark, "empty")
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    write(c, root)
    none = c.filter("c_custkey < 0")
    skipped = is_empty(none) and not is_empty(c) and write(none, root, skip_empty=True) == 0
    return spark.read.parquet(root).groupBy("c_mktsegment").agg(F.count("*").alias("n")).withColumn("empty_skipped", F.lit(skipped))


@register("stream_health", """
WITH s AS (SELECT ts, event_id, COALESCE(event_type, '') AS job, COALESCE(CAST(user_id % 4 AS VARCHAR), '') AS instance,
                  CASE WHEN value >= 10 THEN 1 ELSE 0 END AS up FROM events WHERE event_type <> 'signup' OR ts < TIMESTAMP '2024-01-05'),
v AS (SELECT step, job, instance, up FROM (
        SELECT *, CASE WHEN ts = date_trunc('hour', ts) THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END AS step FROM s) a
      QUALIFY ROW_NUMBER() OVER (PARTITION BY step, job, instance ORDER BY ts DESC, event_id DESC) = 1),
sums AS (SELECT step, job, CAST(SUM(up) AS BIGINT) AS up FROM v GROUP BY step, job),
jobs(job) AS (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('never_seen')),
grid AS (SELECT job, unnest(generate_series((SELECT MIN(step) FROM sums), (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM s), INTERVAL 1 HOUR)) AS step FROM jobs)
SELECT g.step, g.job, s.up, CASE WHEN s.up IS NULL THEN 'Offline' WHEN s.up >= 1 THEN 'green' ELSE 'red' END AS status
FROM grid g LEFT JOIN sums s ON g.step = s.step AND g.job = s.job
WHERE g.step < (SELECT MAX(ts) FROM s) - INTERVAL 10 MINUTE
""")
def stream_health(spark, sf):
    """Live health: a job that dies (signup, after four days) and one that never reports are told Offline by timers."""
    from rivulet.streaming.health import health_stream
    from rivulet.streaming.rate import run_available_now
    root = _io_root(spark, "health")
    samples = fx.metric_samples(_t(spark, sf, "events").filter("event_type <> 'signup' OR ts < '2024-01-05'")).select("event_id", "ts", "job", "instance", "up")
    samples.repartitionByRange(4, "ts").write.parquet(f"{root}/in")
    in_time_order(spark, f"{root}/in")
    first = samples.agg(F.min("ts")).first()[0]
    stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    jobs = spark.createDataFrame([(j,) for j in fx.EVENT_JOBS + ["never_seen"]], "job string")
    out = health_stream(stream, jobs, "job", "instance", "ts", "up", "event_id", step_seconds=3600, watermark="10 minutes", start=first)
    return run_available_now(spark, out, f"{root}/out", f"{root}/state", rocksdb=True)
