import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.dedup import dedup_file_order, first_in_file_order
from rivulet.plans.load import load_incremental, read_partitions, upsert_partitions, upsert_versioned
from rivulet.sinks.files import (
    append_audit, publish, write, write_csv, write_json, write_stream_audited, write_text, write_versioned,
)
from rivulet.sources.files import (
    csv_rejects, file_facts, file_listing, is_complete, is_complete_path, is_fresh, is_fresh_path, newest_dataset, read_csv,
    read_first_available, read_latest_version, read_lines, read_newest_dataset,
)


def test_csv_roundtrip_with_quotes_and_newlines(spark, tmp_dir):
    df = spark.createDataFrame([("a", 'He said "hi",\nthen left', "£51.77"), ("b", None, "Â£10.50")],
                               "url string, description string, prix_ttc string")
    path = os.path.join(tmp_dir, "books_csv")
    assert write_csv(df, path) == 2
    from rivulet.sources.files import csv_rejects
    back, bad = csv_rejects(read_csv(spark, path, multiline=True))
    assert bad.count() == 0
    assert back.columns == ["url", "description", "prix_ttc"]
    got = {r.url: r for r in back.collect()}
    assert got["a"].description == 'He said "hi",\nthen left' and got["b"].prix_ttc == "Â£10.50"


def test_json_text_and_lines(spark, tmp_dir):
    df = spark.createDataFrame([(" https://x/1 ",), ("",), ("https://x/2",)], "link string")
    assert write_text(df, os.path.join(tmp_dir, "links"), "link") == 3
    assert [r.line for r in read_lines(spark, os.path.join(tmp_dir, "links")).collect()] == ["https://x/1", "https://x/2"]
    assert write_json(df, os.path.join(tmp_dir, "js")) == 3
    assert spark.read.json(os.path.join(tmp_dir, "js")).count() == 3


def test_versioned_write_latest_read_and_audit(spark, tmp_dir):
    root = os.path.join(tmp_dir, "population_silver")
    v1 = spark.createDataFrame([("FR", 2020, 1.0)], "country_iso2 string, year int, population double")
    v2 = spark.createDataFrame([("FR", 2020, 2.0), ("DE", 2020, 3.0)], "country_iso2 string, year int, population double")
    p1, n1 = write_versioned(v1, root, dt.datetime(2024, 1, 1, 0, 0, 0))
    p2, n2 = write_versioned(v2, root, "20240102_000000")
    assert (n1, n2) == (1, 2) and p2.endswith("version=20240102_000000")
    latest = read_latest_version(spark, root)
    assert sorted(r.population for r in latest.collect()) == [2.0, 3.0]
    assert {r.version for r in latest.collect()} == {"20240102_000000"}
    os.makedirs(os.path.join(root, "version=20240103_000000"))          # a failed / running write
    assert read_latest_version(spark, root).first().version == "20240102_000000"
    audit = os.path.join(tmp_dir, "audit_population")
    append_audit(spark, audit, "population_silver", n1, p1)
    append_audit(spark, audit, "population_silver", n2, p2)
    rows = spark.read.parquet(audit).orderBy("rows").collect()
    assert [r.rows for r in rows] == [1, 2] and rows[1].file_path == p2


def test_partitioned_publish_and_pruning(spark, tmp_dir):
    df = spark.createDataFrame([("FR", "Europe", 1.0), ("KE", "Africa", 2.0)], "iso2 string, region string, v double")
    path, n = publish(df, tmp_dir, "silver", "countries", partition_by=["region"])
    assert n == 2 and os.path.isdir(os.path.join(path, "region=Africa"))
    back = spark.read.parquet(path).filter(F.col("region") == "Africa")
    assert [r.iso2 for r in back.collect()] == ["KE"]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_write_observed_metrics(spark, tmp_dir):
    from pyspark.sql import functions as F

    from rivulet.sinks.files import write_observed
    df = spark.createDataFrame([("a",), (None,), ("c",)], "titre string")
    m = write_observed(df, os.path.join(tmp_dir, "obs"), {"null_titles": F.count_if(F.col("titre").isNull())})
    assert m == {"rows": 3, "null_titles": 1}


def test_skip_empty_write(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    assert write(spark.range(0), path, skip_empty=True) == 0 and not os.path.exists(path)
    assert write(spark.range(3), path, skip_empty=True) == 3


def test_fallback_newest_file_and_gates(spark, tmp_dir):
    gold = os.path.join(tmp_dir, "gold")
    silver = os.path.join(tmp_dir, "silver_csv")
    write_csv(spark.createDataFrame([("x",)], "a string"), silver)
    assert read_first_available(spark, [(gold, "parquet"), (silver, "csv")]).first().a == "x"
    folder = os.path.join(tmp_dir, "flat")
    write(spark.range(1000).repartition(4), os.path.join(folder, "load1"))
    write(spark.range(500).repartition(4), os.path.join(folder, "load2"))
    rows, path = newest_dataset(spark, folder)
    assert rows.count() == 500 and path.endswith("load2") and read_newest_dataset(spark, folder).count() == 500
    write(spark.range(7).coalesce(1), os.path.join(folder, "load3"))
    os.remove(os.path.join(folder, "load3", "_SUCCESS"))               # still being written: not a dataset yet
    assert newest_dataset(spark, folder)[1].endswith("load2")
    write(spark.range(0), os.path.join(folder, "load4"))
    assert newest_dataset(spark, folder)[0].isEmpty()                    # empty is empty, no older load instead
    assert newest_dataset(spark, os.path.join(tmp_dir, "nope")) == (None, None)
    folder = os.path.join(folder, "load2")
    assert file_listing(spark, folder).count() == 4
    assert is_fresh_path(spark, folder, dt.datetime.now(dt.timezone.utc).date())
    assert not is_fresh_path(spark, folder, "2000-01-01")
    assert is_complete_path(spark, folder, 10) and not is_complete_path(spark, folder, 10 ** 9)
    df = spark.read.parquet(folder)
    assert is_fresh(df, dt.datetime.now(dt.timezone.utc).date())
    assert not is_fresh(df, "2000-01-01")
    from rivulet.sources.files import utc_date
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")      # UTC+14
    try:
        t = spark.sql("SELECT TIMESTAMP'2024-01-01 23:30:00Z' AS t").select(utc_date("t")).first()[0]
        assert str(t) == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert is_complete(df, min_rows=2) and not is_complete(df, min_rows=501)
    assert is_complete(df, min_bytes=10) and not is_complete(df, min_bytes=10**9)
    assert file_facts(df).count() >= 2


def test_upsert_versioned_end_to_end(spark, tmp_dir):
    root, audit = os.path.join(tmp_dir, "population"), os.path.join(tmp_dir, "audit_postgres")
    s = "indicator_id string, country_iso2 string, country_name string, year int, population double, ingestion_timestamp string, year_month string"
    b1 = spark.createDataFrame([("P", "FR", "France", 2020, 1.0, "t1", "2020-01")], s)
    b2 = spark.createDataFrame([("P", "FR", "FRANCE", 2020, 5.0, "t2", "2020-01"),
                                ("P", "DE", "Germany", 2020, 7.0, "t2", "2020-01")], s)
    upsert_versioned(spark, b1, root, audit, "population", stamp="20240101_000000")
    upsert_versioned(spark, b2, root, audit, "population", stamp="20240102_000000")
    got = {r.country_iso2: r for r in read_latest_version(spark, root).collect()}
    assert (got["FR"].population, got["FR"].country_name, got["FR"].ingestion_timestamp) == (5.0, "France", "t2")
    assert got["DE"].population == 7.0
    audit_rows = spark.read.parquet(audit).collect()
    assert sorted(r.rows_loaded for r in audit_rows) == [1, 2] and {r.source for r in audit_rows} == {"local"}
    upsert_versioned(spark, b2.limit(1), root, audit, "population", stamp="20240102_120000",
                     source_path="s3a://lake/raw/population/b3.parquet")
    last = spark.read.parquet(audit).orderBy("loaded_at").collect()[-1]
    assert (last.rows_loaded, last.file_path) == (1, "s3a://lake/raw/population/b3.parquet")
    dup = spark.createDataFrame([("P", "IT", "Italy", 2020, 1.0, "t3", "2020-01")] * 2, s)
    try:
        upsert_versioned(spark, dup, root, audit, "population", stamp="20240103_000000")
        raise AssertionError("duplicate keys must be refused")
    except ValueError:
        pass


def test_upsert_refuses_what_the_database_would_and_recovers(spark, tmp_dir):
    import pytest

    from rivulet.operators.upsert import upsert
    from rivulet.plans.load import load_newest
    s = "k string, v int"
    target = spark.createDataFrame([("a", 1)], s)
    with pytest.raises(ValueError):
        upsert(target, spark.createDataFrame([("a", 1, 2)], "k string, v int, extra int"), ["k"], ["v"])
    with pytest.raises(Exception, match="null key"):
        upsert(target, spark.createDataFrame([(None, 1)], s), ["k"], ["v"]).collect()
    root, raw, audit = (os.path.join(tmp_dir, x) for x in ("table", "raw", "audit"))
    os.makedirs(os.path.join(root, "version=20240101_000000"))            # a first load that failed
    write(spark.createDataFrame([("a", 1), ("b", 2)], s).repartition(2), os.path.join(raw, "b1"))
    load_newest(spark, raw, root, audit, "t", ["k"], ["v"], stamp="20240102_000000")
    write(spark.createDataFrame([("b", 5), ("c", 6)], s).repartition(2), os.path.join(raw, "b2"))
    load_newest(spark, raw, root, audit, "t", ["k"], ["v"], "object store", "20240103_000000")
    assert sorted(tuple(r) for r in read_latest_version(spark, root).select("k", "v").collect()) == [("a", 1), ("b", 5), ("c", 6)]
    got = [tuple(r) for r in spark.read.parquet(audit).orderBy("loaded_at").select("rows_loaded", "source").collect()]
    assert got == [(2, "local"), (2, "object store")]
    with pytest.raises(ValueError, match="null key"):
        upsert_versioned(spark, spark.createDataFrame([(None, 1)], s), root, audit, "t", ["k"], ["v"])


def test_csv_keeps_white_space_and_marks_odd_lines(spark, tmp_dir):
    from rivulet.sources.files import csv_rejects, read_csv
    path = os.path.join(tmp_dir, "c")
    write_csv(spark.createDataFrame([(" x ", 'q"uote, and'), ("y", None)], "a string, b string"), path)
    good, bad = csv_rejects(read_csv(spark, path))
    assert sorted(map(tuple, good.collect()), key=str) == [(" x ", 'q"uote, and'), ("y", None)] and bad.count() == 0
    with open(os.path.join(tmp_dir, "odd.csv"), "w") as f:
        f.write("a,b\n1,2\n3\n4,5,6\n")
    good, bad = csv_rejects(read_csv(spark, os.path.join(tmp_dir, "odd.csv")))
    assert [tuple(r) for r in good.collect()] == [("1", "2")] and sorted(r[-1] for r in bad.collect()) == ["3", "4,5,6"]


def table_files(root):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{root}/key_part_of_*/part-*")}


def test_upsert_rewrites_only_touched_partitions(spark, tmp_dir):
    root, audit = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "audit")
    s = "k long, v int, w int"

    def load(rows, name, **kw):
        batch = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, s)
        return upsert_partitions(spark, batch, root, ["k"], ["v"], os.path.join(tmp_dir, "staging", name), audit_root=audit, table_name="t", **kw)

    base = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit(1).alias("w"))
    assert len(load(base, "a", parts=8)) == 8
    before = table_files(root)
    touched = load([(5, 7, 9), (1000, 3, 3)], "b", parts=64)  # the first load's 8 partitions hold
    after = table_files(root)
    kept = {p for p in before if int(re.search(r"key_part_of_8=(\d+)", p)[1]) not in touched}
    assert 1 <= len(touched) <= 2 and all(after.get(p) == before[p] for p in kept) and not (before.keys() - kept) & after.keys()
    got = {r.k: (r.v, r.w) for r in read_partitions(spark, root).collect()}
    assert len(got) == 201 and got[5] == (7, 1) and got[1000] == (3, 3) and got[6] == (1, 1)
    for bad in ([(None, 1, 1)], [(1, 1, 1), (1, 2, 2)]):
        with pytest.raises(ValueError):
            load(bad, "bad")
    with pytest.raises(ValueError):
        load(spark.createDataFrame([(1, 2)], "k long, other int"), "bad")
    boom = spark.createDataFrame([(5, 1, 1)], s).withColumn("v", F.raise_error(F.lit("task failed")).cast("int"))
    with pytest.raises(Exception, match="task failed"):
        load(boom, "boom")
    assert table_files(root) == after and load([], "none") == [] and table_files(root) == after
    assert sorted(r.rows_loaded for r in spark.read.parquet(audit).collect()) == [0, 2, 200]
    assert not glob.glob(os.path.join(tmp_dir, "staging", "[ab]"))


def test_failure_while_writing_leaves_the_table(spark, tmp_dir, monkeypatch):
    from rivulet.plans import load as L
    root, s = os.path.join(tmp_dir, "t"), "k long, v int"
    upsert_partitions(spark, spark.createDataFrame([(k, 1) for k in range(50)], s), root, ["k"], ["v"], os.path.join(tmp_dir, "s1"), 4)
    before = table_files(root)
    merge = L.upsert
    monkeypatch.setattr(L, "upsert", lambda *a: merge(*a).withColumn("v", F.when(F.col("k") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))))
    with pytest.raises(Exception, match="lost"):
        upsert_partitions(spark, spark.createDataFrame([(k, 2) for k in range(50)], s), root, ["k"], ["v"], os.path.join(tmp_dir, "s2"), 4)
    assert table_files(root) == before and {r.v for r in read_partitions(spark, root).collect()} == {1}


def test_incremental_load_takes_each_file_once(spark, tmp_dir):
    at = lambda *p: os.path.join(tmp_dir, *p)
    s = "k long, v string"

    def put(name, rows, when):
        spark.createDataFrame(rows, s).coalesce(1).write.parquet(at("raw", name))
        for part in glob.glob(at("raw", name, "part-*")):
            os.utime(part, (when, when))

    def load():
        audit = load_incremental(spark, at("raw"), s, at("table"), at("audit"), at("state"), "t", ["k"], ["v"], parts=4)
        return {r.k: r.v for r in read_partitions(spark, at("table")).collect()}, sorted(r.rows_loaded for r in audit.collect())

    put("a", [(1, "a"), (2, "a")], 1_700_000_100)
    put("b", [(2, "b"), (3, "b"), (3, "c")], 1_700_000_200)  # in the same batch: the newest file, then its last row
    assert load() == ({1: "a", 2: "b", 3: "c"}, [5])
    assert load() == ({1: "a", 2: "b", 3: "c"}, [5])
    put("c", [(1, "d")], 1_700_000_300)
    assert load() == ({1: "d", 2: "b", 3: "c"}, [1, 5])


def test_partitioned_write_splits_a_hot_partition_and_merges_small_ones(spark, tmp_dir):
    path = os.path.join(tmp_dir, "hot")
    rows = spark.range(400_000).select(F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 5)).alias("region"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(8)
    # enough shuffle partitions that no small region shares the hot one's
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert write(rows, path, partition_by=["region"]) == 400_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {region: [os.path.getsize(p) for p in glob.glob(f"{path}/region={region}/part-*")] for region in ("hot", "r0", "r4")}
    assert len(files["hot"]) >= 3 and max(files["hot"]) < 16 << 20 and len(files["r0"]) <= 2 and len(files["r4"]) <= 2
    assert spark.read.parquet(path).groupBy("region").count().count() == 6


def test_first_row_in_file_order(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    os.makedirs(path)
    for k, lines in enumerate((["b,1", "a,2", "a,1"], ["a,0", "c,9", "b,0"])):
        with open(os.path.join(path, f"part-{k}.csv"), "w") as f:
            f.write("\n".join(lines))
    df = spark.read.schema("k string, v int").csv(path)
    assert {(r.k, r.v) for r in dedup_file_order(df, ["k"]).collect()} == {("b", 1), ("a", 2), ("c", 9)}
    assert tuple(first_in_file_order(df).first()) == ("b", 1)
    assert first_in_file_order(df.filter("v > 100")).collect() == []


def test_no_csv_value_is_cut(spark, tmp_dir):
    path = os.path.join(tmp_dir, "books")
    rows = [("u1", "two\nlines"), ("u2", 'a "quoted", text\n\nwith blank lines'), ("u3", "plain"), ("u4", None), ("u5", "comma, only")]
    write_csv(spark.createDataFrame(rows, "url string, description string"), path)
    back = read_first_available(spark, [(os.path.join(tmp_dir, "none"), "parquet"), (path, "csv")])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    good, bad = csv_rejects(read_csv(spark, path))  # by lines: what spans lines is rejected, not cut
    assert sorted((r.url, r.description) for r in good.collect() if r.url.startswith("u")) == [("u3", "plain"), ("u4", None), ("u5", "comma, only")]
    with open(os.path.join(tmp_dir, "latin.csv"), "wb") as f:
        f.write('a,b\n1,"é\nü"\n'.encode("latin-1"))
    assert [tuple(r) for r in csv_rejects(read_csv(spark, os.path.join(tmp_dir, "latin.csv"), encoding="ISO-8859-1"))[0].collect()] == [("1", "é\nü")]
    lines = [r[-1] for r in bad.collect()]
    assert 'u1,"two' in lines and 'lines"' in lines and 'with blank lines"' in lines


def test_newest_dataset_and_freshness_by_a_metadata_scan(spark, tmp_dir):
    root = os.path.join(tmp_dir, "lake")
    for k, name in enumerate(("a/old", "a/new", "single")):
        write(spark.range(3).withColumn("n", F.lit(name)).repartition(3), os.path.join(root, name))
        for part in glob.glob(os.path.join(root, name, "part-*")):
            os.utime(part, (1_700_000_000 + 100 * k,) * 2)
    assert newest_dataset(spark, root)[1].endswith("/single")
    assert is_fresh_path(spark, root, "2023-11-14") and not is_fresh_path(spark, root, "2023-11-15")
    assert not is_fresh_path(spark, os.path.join(tmp_dir, "none"), "2023-11-14")
    plan = file_listing(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]  # the files' bytes are not read
    assert newest_dataset(spark, os.path.join(root, "single"))[1].endswith("/single")


def test_stream_audit_counts_each_batch(spark, tmp_dir):
    at = lambda p: os.path.join(tmp_dir, p)
    write(spark.range(90).repartition(3), at("in"))
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(at("in"))
    for _ in range(2):  # a second run finds nothing new
        audit = write_stream_audited(stream(), at("out"), at("audit"), "t", at("state"))
        assert sorted(r.rows for r in audit.collect() if r.rows) == [30, 30, 30] and spark.read.parquet(at("out")).count() == 90


def test_incremental_load_of_one_dense_file_is_dealt_by_rows(spark, tmp_dir, monkeypatch):
    """A file that one task reads is merged by as many tasks as its rows ask for, a key that half of them share included."""
    from rivulet.operators import dedup
    from rivulet.plans import load as L
    monkeypatch.setattr(dedup, "ROWS_PER_TASK", 100)
    checked, check = [], L.batch_size_checked
    monkeypatch.setattr(L, "batch_size_checked", lambda df, keys: checked.append(df.rdd.getNumPartitions()) or check(df, keys))
    at = lambda *p: os.path.join(tmp_dir, *p)
    rows = spark.range(2000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").cast("string").alias("v"))
    for name, df, tasks in (("a", rows, 11), ("b", rows.filter("k > 0").withColumn("v", F.lit("new")), 10)):
        df.coalesce(1).write.parquet(at("raw", name))
        audit = load_incremental(spark, at("raw"), "k long, v string", at("table"), at("audit"), at("state"), "t", ["k"], ["v"], parts=3)
        assert checked.pop() == tasks
    got = {r.k: r.v for r in read_partitions(spark, at("table")).collect()}
    assert got == {-1: "1998", **{k: "new" for k in range(1, 2000, 2)}} and sorted(r.rows_loaded for r in audit.collect()) == [1000, 2000]
    assert read_partitions(spark, at("table")).count() == 1001


def test_file_order_of_one_dense_file_is_dealt_by_rows(spark, tmp_dir, monkeypatch):
    """Rows of one split go to several tasks before they are sorted; the first row per key stays the same."""
    from rivulet.operators import dedup
    path = os.path.join(tmp_dir, "dense")
    spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 7 % 3001).alias("v")).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    whole = sorted(map(tuple, dedup_file_order(df, ["k"]).collect()), key=repr)
    monkeypatch.setattr(dedup, "ROWS_PER_TASK", 200)
    spread = dedup_file_order(df, ["k"])
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("REPARTITION_BY_NUM") > plan.rindex("Sort [")  # nothing is sorted where the file is read
    assert sorted(map(tuple, spread.collect()), key=repr) == whole and len(whole) == 51
