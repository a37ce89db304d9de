import re

import corpus_pipeline as C
from rivulet.llm import decontaminate, language_hd, packing, simhash_tiles, toxicity
from rivulet.llm.queries import QUERIES, toxicity_lexicon

SF = "/root/testdata/sf0.001"


def test_stages_and_names():
    assert [n for n, _ in C.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "decontamination", "packing"]


def test_run_equals_the_operators_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    scored = toxicity.score(docs, toxicity_lexicon(docs, labels), keep=["doc_id"])
    docs = docs.join(scored.filter("predicted = 0"), "doc_id", "left_semi")
    told = language_hd.identify(docs, language_hd.learn(docs, where=C.crc_part(docs["doc_id"], 4) != 2), keep=["doc_id"])
    docs = docs.join(told.filter("lang_pred <> 'und' and score >= 0.25 - 3 / sqrt(n_letters)"), "doc_id", "left_semi")
    found = simhash_tiles.simhash_components(docs)
    docs = docs.join(found.filter("doc_id = component_id"), "doc_id", "left_semi")
    clean = decontaminate.contamination(docs, bench, keep=["doc_id"]).filter("not contaminated")
    docs = docs.join(clean, "doc_id", "left_semi").select(cols)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    expected = sorted(map(tuple, packing.pack(docs).select(key).collect()))
    got = C.run(spark, SF).collect()
    assert sorted(tuple(r[c] for c in key) for r in got) == expected and expected


def test_stages_take_awkward_and_empty_tables(spark, tmp_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, fingerprint string"
    rows = [(1, "the thing with another", "en", "a", 1, "s", "f"), (1, "the thing with another", "en", "a", 1, "s", "f"), (2, None, None, None, None, None, None),
            (None, "and the other thing", "en", "a", 1, "s", "f"), (3, "", "en", "a", 1, "s", "f"), (4, "12 34 !!", "en", "a", 1, "s", "f")]
    spark.createDataFrame([], "doc_id bigint, toxic int, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        for _, stage in C.STAGES[:-1]:
            docs = stage(spark, docs, tmp_dir)
            assert docs.columns == re.findall(r"(\w+) \w+", schema)
        ids = sorted(((r["doc_id"] or 0) for r in docs.collect()))
        assert ids == ([0, 1] if part else [])
        assert {r["doc_id"] or 0 for r in C.STAGES[-1][1](spark, docs, tmp_dir).collect()} == set(ids)


def test_registered_queries():
    import __spark_entry__ as entry
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
