from pyspark.sql import functions as F

from rivulet.operators.keys import dense_ids, hashed_ids
from rivulet.operators.quality import (
    assert_unique, duplicate_keys, null_violations, orphans, too_long, violation_counts,
)
from rivulet.operators.upsert import append, upsert


def test_constraint_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "toolongname")], "id int, name string")
    assert [tuple(r) for r in duplicate_keys(df, ["id"]).collect()] == [(1, 2)]
    assert [r.id for r in null_violations(df, ["name"]).collect()] == [2]
    assert [r.id for r in too_long(df, "name", 5).collect()] == [3]
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert [r.id for r in orphans(df, parent, "id", "pk").collect()] == [3]
    v = violation_counts(df, ["name"], {"name": 5}).first()
    assert (v.rows, v.null_name, v.too_long_name) == (4, 1, 1)
    try:
        assert_unique(df, ["id"])
        raise AssertionError("expected a duplicate key error")
    except ValueError as e:
        assert "duplicate key" in str(e)
    assert_unique(df.filter("id > 1"), ["id"])


def test_dense_ids_ordered_across_partitions(spark):
    names = spark.range(0, 500, numPartitions=7).select(F.format_string("n%04d", (F.col("id") * 37) % 500).alias("name"))
    names = names.union(names).union(spark.createDataFrame([(None,)], "name string"))
    got = dense_ids(names.repartition(5), "name").orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 501))
    assert [r.name for r in got] == sorted(r.name for r in got)


def test_hashed_ids_are_stable(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "name string")
    a = {r.name: r.id for r in hashed_ids(df, "name").collect()}
    b = {r.name: r.id for r in hashed_ids(df.orderBy(F.desc("name")), "name").collect()}
    assert a == b and len(a) == 2


def test_upsert_semantics(spark):
    target = spark.createDataFrame(
        [("FR", 2020, "France", 1.0, "t0"), ("DE", 2020, "Germany", 2.0, "t0"), ("IT", 2020, "Italy", 3.0, "t0")],
        "country_iso2 string, year int, country_name string, population double, ingestion_timestamp string")
    updates = spark.createDataFrame(
        [("FR", 2020, "FRANCE-NEW", 10.0, "t1"), ("DE", 2020, "X", None, "t1"), ("ES", 2020, "Spain", 4.0, "t1")],
        "country_iso2 string, year int, country_name string, population double, ingestion_timestamp string")
    out = {r.country_iso2: tuple(r) for r in upsert(target, updates, ["country_iso2", "year"],
                                                    ["population", "ingestion_timestamp"]).collect()}
    assert out["FR"] == ("FR", 2020, "France", 10.0, "t1")      # updated cols from source, rest kept
    assert out["DE"] == ("DE", 2020, "Germany", None, "t1")     # null update is applied
    assert out["IT"] == ("IT", 2020, "Italy", 3.0, "t0")        # untouched
    assert out["ES"] == ("ES", 2020, "Spain", 4.0, "t1")        # inserted
    assert len(out) == 4


def test_append_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "rows int, t string")
    b = spark.createDataFrame([("y", 2, "s")], "t string, rows int, source string")
    got = sorted(tuple(r) for r in append(a, b).collect())
    assert got == [(1, "x", None), (2, "y", "s")]
    assert append(None, b).count() == 1
