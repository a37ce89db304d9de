import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import language_hd as L
from rivulet.llm.batches import crc_part

from .cases import AWKWARD, docs, empty

SF = "/root/testdata/sf0.01"


def naive(space, text):
    """Bind and bundle gram by gram."""
    symbols = [ord(c) if c.isalpha() else 32 for c in text.lower()] + [32]
    run = [c for k, c in enumerate(symbols) if c != 32 or k == 0 or symbols[k - 1] != 32]
    out = np.zeros(space.dimensions)
    for a, b, c in zip(run, run[1:], run[2:]):
        out += np.roll(space.letter(a), 2).astype(int) * np.roll(space.letter(b), 1) * space.letter(c)
    return out


def test_bundles_equal_gram_by_gram():
    space = L.Space(128)
    texts = ["Hello, World 12 again", "", "a", "ab", "  été à Ærø!! ", "漢字 かな", "x" * 300, "!!", "İstanbul"]
    got, letters = space.bundles([t.encode() for t in texts] + [None], rows=4)
    for k, t in enumerate(texts):
        assert (got[k] == naive(space, t)).all(), t
    assert letters.tolist() == [sum(c.isalpha() for c in t.lower()) for t in texts] + [0]


def test_many_gram_kinds_go_in_blocks(monkeypatch):
    texts = ["".join(chr(0x4E00 + (k * 37 + j * j) % 3000) for j in range(400)).encode() for k in range(30)]
    space = L.Space(64)
    one = space.bundles(texts)[0]
    monkeypatch.setattr(L, "compact", lambda v: np.unique(v, return_inverse=True)[::-1])
    assert (space.bundles(texts, rows=7)[0] == one).all()


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    held = crc_part(F.col("doc_id"), 4) == 2
    profiles = L.learn(df, where=~held)
    got = L.identify(df.filter(held), profiles, keep=["doc_id", "lang"]).filter("lang is not null").collect()
    assert len(got) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_learning_is_the_same_for_any_partitioning(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = L.learn(df.repartition(1)), L.learn(df.repartition(5))
    assert a.languages == b.languages and np.allclose(a.prototypes, b.prototypes, atol=1e-5)


def test_awkward_rows(spark):
    learned = L.learn(spark.createDataFrame([("the thing with the other", "en"), ("der die das und", "de"), (None, "fr"), ("x", None), ("", "es")],
                                            "text string, lang string"))
    assert learned.languages == ["de", "en"]
    got = {(r["doc_id"], r["text"]): r for r in L.identify(docs(spark), learned).collect()}
    assert got[(2, None)]["lang_pred"] == got[(3, "")]["lang_pred"] == got[(4, " \t\n ")]["lang_pred"] == "und"
    assert got[(7, "!!! ... 12 34")]["lang_pred"] == "und" and got[(7, "!!! ... 12 34")]["score"] == 0
    assert got[(8, AWKWARD[-1][1])]["lang_pred"] in ("de", "en")
    assert isinstance(got[(6, "one")]["score"], float) and got[(6, "one")]["w"] == "own"
    assert L.identify(empty(spark), learned).count() == 0


def test_nothing_learned(spark):
    none = L.learn(spark.createDataFrame([], "text string, lang string"))
    assert {(r["lang_pred"], r["score"]) for r in L.identify(docs(spark), none, keep=["doc_id"]).collect()} == {("und", 0.0)}


def test_stage_drops_letterless_texts_only(spark):
    learned = L.learn(spark.createDataFrame([("the thing with the other", "en")], "text string, lang string"))
    df = docs(spark, [(1, "the other"), (2, None), (3, "12 !!"), (4, "the")])
    left = L.drop_unidentified(df, learned)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 4]
    assert {r["score"] for r in left.collect()} == {"own"}


def test_one_letter_texts_get_a_language(spark):
    learned = L.learn(spark.createDataFrame([("I saw a cat and a dog", "en"), ("y el y la y", "es"), ("\u6f22", "zh")], "text string, lang string"))
    assert learned.languages == ["en", "es", "zh"]
    df = docs(spark, [(1, "a"), (2, "y"), (3, "a!! 12"), (4, "\u6f22"), (5, "\u5b57"), (6, "!a"), (7, "1"), (8, "Y.")])
    got = {r["doc_id"]: r for r in L.identify(df, learned).collect()}
    assert [got[k]["lang_pred"] for k in (1, 2, 3, 4, 6, 7, 8)] == ["en", "es", "en", "zh", "en", "und", "es"]
    assert got[5]["lang_pred"] in learned.languages and got[1]["score"] > 0 and got[7]["score"] == 0
    assert sorted(r["doc_id"] for r in L.drop_unidentified(df, learned).collect()) == [1, 2, 3, 4, 5, 6, 8]


@pytest.mark.parametrize("values", [[3, 1, 3, 9], [1 << 40, 5, 1 << 40], []])
def test_compact(values):
    index, kinds = L.compact(np.array(values, np.int64))
    assert kinds[index].tolist() == values if values else len(kinds) == 0
