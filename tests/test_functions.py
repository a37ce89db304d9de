from pyspark.sql import functions as F

from rivulet.functions.clean import (
    clean_availability, clean_price_digits, clean_price_strict, clean_reviews, concat_year_month,
    main_currency, round_half_even, safe_ratio, strip_whitespace, version_stamp,
)


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_clean_price_pinned_values(spark):
    # values pinned by the reference's unit tests ("invalid" is NaN there, null here)
    assert col_values(spark, ["£51.77", "Â£10.50", "invalid"], clean_price_strict) == [51.77, 10.50, None]
    assert col_values(spark, [20.0], clean_price_strict, "double") == [20.0]


def test_clean_price_strict_edges(spark):
    got = col_values(spark, [".", "-5.00", "1.2.3", "1d", " 12 ", "1e3", None, ""], clean_price_strict)
    assert got == [None, -5.0, None, None, 12.0, 1000.0, None, None]


def test_clean_price_digits_edges(spark):
    got = col_values(spark, ["£51.77", ".", "-5.00", "1.2.3", "1d", "", None], clean_price_digits)
    assert got == [51.77, None, 5.0, None, 1.0, None, None]


def test_clean_availability_pinned_values(spark):
    got = col_values(spark, ["In stock (22 available)", "In stock (0 available)", "Empty", None],
                     clean_availability)
    assert got == [22, 0, 0, 0]
    assert col_values(spark, ["Empty", "In stock (3 available)"], lambda c: clean_availability(c, None)) == [None, 3]


def test_clean_reviews_pinned_values(spark):
    assert col_values(spark, ["5", None, "10", "5.0", "x"], clean_reviews) == [5, 0, 10, 5, 0]
    assert col_values(spark, [10], clean_reviews, "int") == [10]


def test_currency_conversion(spark):
    df = spark.createDataFrame([(10.0,), (20.0,)], "price_incl_tax double")
    out = df.select((F.col("price_incl_tax") * 1.2).alias("eur"), (F.col("price_incl_tax") * 1.3).alias("usd")).collect()
    assert out[0]["eur"] == 12.0 and out[1]["usd"] == 26.0


def test_density_and_zero_divisor(spark):
    df = spark.createDataFrame([(67000000, 550000.0), (5, 0.0), (None, 3.0)], "p long, a double")
    got = [r[0] for r in df.select(safe_ratio("p", "a")).collect()]
    assert got[0] == 67000000 / 550000 and got[1] is None and got[2] is None


def test_round_like_a_dataframe(spark):
    import numpy as np
    vals = [917.5 * 1.17, 2.675, 0.125, -0.125, 1209.965, 0.375]
    got = col_values(spark, vals, lambda c: round_half_even(c, 2), "double")
    assert got == [float(np.round(v, 2)) for v in vals]


def test_main_currency_and_strip(spark):
    assert col_values(spark, ["USD, EUR", "", None, " KES "], main_currency) == ["USD", "", None, "KES"]
    assert col_values(spark, ["\t a b \n", None], strip_whitespace) == ["a b", None]


def test_year_month_and_version(spark):
    assert col_values(spark, [2021, None], concat_year_month, "int") == ["2021-01", None]
    df = spark.sql("SELECT TIMESTAMP'2024-01-31 23:59:58' AS t")
    assert df.select(version_stamp("t")).first()[0] == "20240131_235958"


def test_scale_conf_sizes_partitions():
    from rivulet.session import scale_conf
    c = scale_conf(100 * 1024 ** 4)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "200"


def test_processing_time_is_utc_wall_clock(spark):
    import datetime as dt

    from rivulet.functions.clean import processing_time, uptime_seconds
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = spark.range(1).select(processing_time("2024-01-31 12:00:00").alias("a"),
                                  processing_time(dt.datetime(2024, 1, 31, 12, 0, tzinfo=dt.timezone.utc)).alias("b"),
                                  processing_time().alias("c"),
                                  uptime_seconds(F.lit(1706702400 - 60), "2024-01-31 12:00:00").alias("u")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.a == r.b == dt.datetime(2024, 1, 31, 12, 0)
    assert abs((r.c - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 120
    assert r.u == 60.0
