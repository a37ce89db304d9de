from pyspark.sql import functions as F

from rivulet.operators.dedup import dedup_first, distinct_rows
from rivulet.operators.joins import (
    broadcast_if_small, latest_per_key, left_enrich, rate_lookup, rates_long, scalar_enrich,
)


def test_latest_per_key_keeps_ties_and_drops_null_keys(spark):
    pop = spark.createDataFrame(
        [("FR", 2020, 1.0), ("FR", 2021, 2.0), ("FR", 2021, 3.0), ("DE", 2019, 4.0),
         (None, 2030, 9.0), ("IT", None, 5.0)], "k string, y int, v double")
    got = sorted(tuple(r) for r in latest_per_key(pop, "k", "y").collect())
    assert got == [("DE", 2019, 4.0), ("FR", 2021, 2.0), ("FR", 2021, 3.0)]


def test_latest_per_key_plans_window_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("y"))
    plan = latest_per_key(df, "k", "y")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_left_enrich_fans_out_and_drops_right_key(spark):
    c = spark.createDataFrame([("FR",), ("DE",), ("ES",)], "iso2 string")
    p = spark.createDataFrame([("FR", 1.0), ("FR", 2.0), ("DE", 3.0)], "country_iso2 string, pop double")
    out = left_enrich(c, p, "iso2", "country_iso2")
    assert out.columns == ["iso2", "pop"]
    assert sorted(out.collect(), key=lambda r: (r.iso2, r.pop or 0)) == sorted(
        [("DE", 3.0), ("ES", None), ("FR", 1.0), ("FR", 2.0)], key=lambda r: (r[0], r[1] or 0))


def test_rate_lookup_takes_columns_that_read_as_numbers(spark):
    rates = spark.createDataFrame([(1.27, 1.17, "GBP", "2024-01-01", "23.5", None)],
                                  "USD double, EUR double, base string, date string, ZAR string, KES double")
    assert sorted(tuple(r) for r in rates_long(rates).collect()) == [("EUR", 1.17), ("USD", 1.27), ("ZAR", 23.5)]
    df = spark.createDataFrame([("USD",), ("GBP",), (None,), ("",)], "code string")
    got = {r.code: r.rate for r in rate_lookup(df, "code", rates, "rate").collect()}
    assert got == {"USD": 1.27, "GBP": None, None: None, "": None}


def test_scalar_enrich_first_row_and_missing_columns(spark):
    df = spark.createDataFrame([(10.0,), (20.0,)], "p double")
    rates = spark.createDataFrame([(1.2, 9.9)], "EUR double, ZAR double")
    out = scalar_enrich(df, rates, {"eur": ("p", "EUR"), "usd": ("p", "USD")})
    assert out.columns == ["p", "eur"]
    assert [r.eur for r in out.collect()] == [12.0, 24.0]
    assert scalar_enrich(df, None, {"eur": ("p", "EUR")}).columns == ["p"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _analyzed(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_broadcast_if_small_checks_size(spark):
    assert "broadcast" in _analyzed(broadcast_if_small(spark.range(5), 10)).lower()
    assert "broadcast" not in _analyzed(broadcast_if_small(spark.range(50), 10)).lower()
    wide = spark.range(5).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert "broadcast" not in _analyzed(broadcast_if_small(wide, 10, max_bytes=4000)).lower()
    assert "broadcast" in _analyzed(broadcast_if_small(wide, 10, max_bytes=10_000)).lower()


def test_dedup_first_is_deterministic(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 1, "n1"), (None, 0, "n0")],
                               "k string, o int, v string")
    got = sorted(((r.k or ""), r.v) for r in dedup_first(df, ["k"], ["o"]).collect())
    assert got == [("", "n0"), ("a", "y"), ("b", "z")]
    assert distinct_rows(spark.createDataFrame([(1,), (1,), (2,)], "a int")).count() == 2



def test_rates_row_is_the_newest_date(spark):
    rates = spark.createDataFrame([(1.10, 1.20, "2024-01-30"), (1.15, 1.25, "2024-01-31"), (9.0, 9.0, None)],
                                  "EUR double, USD double, date string")
    df = spark.createDataFrame([(10.0,)], "p double")
    r = scalar_enrich(df, rates, {"eur": ("p", "EUR"), "usd": ("p", "USD")}).first()
    assert (r.eur, r.usd) == (11.5, 12.5)
    assert dict(tuple(x) for x in rates_long(rates).collect()) == {"EUR": 1.15, "USD": 1.25}
