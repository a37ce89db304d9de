import random
import time

import numpy as np
from pyspark.sql import functions as F

from rivulet.llm import toxicity as X
from rivulet.llm.batches import crc_part

from .cases import docs, empty

SF = "/root/testdata/sf0.01"
LEXICON = X.Lexicon({" idiot": 5.0, " trash ": 4.0, " vequ": 3.0}, bias=-4.0, slope=4.0)


def test_folding():
    fold = lambda t: X.words_of(t.encode())
    assert fold("1D10T! IdI0t іdіоt ｉｄｉｏｔ id​iot") == ["idiot"] * 5
    assert fold("10 apples, 2024-05-01 $5 @home") == ["apples", "ahome"]
    assert fold("l0ser $tupid m0r0n.") == ["loser", "stupid", "moron"]
    assert fold("") == [] and X.words_of(None) == []


def test_whole_words_beginnings_and_exceptions():
    one = LEXICON.matcher()
    assert one(b"you idiots, TRASH!")[:2] == (3, 2)
    assert one(b"trashy midiot")[1] == 0
    assert one(b"put it in the Trash-can, please")[1] == 0
    assert one("vequée vequ4 veque".encode())[1] == 3
    assert one(b"the trash can is trash")[1] == 1


def brute(lexicon, text):
    """Every word start against every entry and every exception, in both readings."""
    first, other = X.readings(text)
    hits, spared = {}, set()
    for words in (first, other):
        line = f" {' '.join(words)} "
        for at in range(len(line)):
            for pattern, weight in lexicon.weights.items():
                if line.startswith(pattern, at):
                    hits[at] = max(weight, hits.get(at, 0))
            for phrase in lexicon.exceptions:
                folded = f" {' '.join(X.words_of(phrase.encode()))} "
                if line.startswith(folded, at):
                    spared |= set(range(at, at + len(folded) - 1))
    return len(first), sum(at not in spared for at in hits)


def test_matches_equal_brute_force():
    r = random.Random(4)
    lexicon = X.Lexicon({" idiot": 5.0, " trash ": 4.0, " los": 2.0, " loser ": 3.0, " can ": 1.0, " trash c": 6.0},
                        exceptions=("trash can", "can trash", "sore loser", "trash can trash"))
    one = lexicon.matcher()
    bits = ["trash", "can", "Trash-can", "1oser", "l0ser", "|oser", "sore", "1d1ot", "idiotic", "tr4sh", "and", "loss!", "sore 1oser", "!", "lo$er", ""]
    for _ in range(400):
        text = " ".join(r.choice(bits) for _ in range(r.randrange(12))).encode()
        assert one(text)[:2] == brute(lexicon, text), text


def test_signs_that_stand_for_two_letters():
    one = X.Lexicon({" loser ": 3.0, " idiot ": 3.0}).matcher()
    assert [one(t)[1] for t in (b"1oser", b"|oser", b"1d1ot", b"|d|ot", b"!oser x", b"l0ser", b"100ser")] == [1, 1, 1, 1, 1, 1, 0]


def test_very_long_text_with_many_exceptions():
    text = b"trash can and trash " * 500_000  # 10 MB
    began = time.time()
    assert LEXICON.matcher()(text)[:2] == (2_000_000, 500_000)
    assert time.time() - began < 20


def test_density_falls_with_length():
    one = LEXICON.matcher()
    short, long = one(b"idiot " + b"word " * 10)[2], one(b"idiot " + b"word " * 5000)[2]
    assert short > long > 0 and LEXICON.score(short) > LEXICON.score(long)


def test_choice_prefers_beginnings_that_gain():
    got = X.choose([(" path", 50, 6.0), (" pathet", 50, 6.0), (" pathetic ", 50, 6.0), (" lowe", 90, 6.0), (" lowei", 90, 6.0),
                    (" loweix ", 30, 5.0), (" loweiy ", 40, 5.0)])
    assert got == {" pathetic ": 6.0, " lowei": 6.0}


def test_held_out_accuracy(spark):
    df, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = crc_part(F.col("doc_id"), 3) == 1
    lexicon = X.fit(df, labels.filter(~held))
    got = X.score(df.select("doc_id", "text"), lexicon, keep=["doc_id"]).filter(held).join(labels, "doc_id").collect()
    truth, said = np.array([r["toxic"] for r in got]), np.array([r["predicted"] for r in got])
    assert len(got) > 80 and (truth == said).mean() >= 0.95
    assert said[truth == 0].mean() <= 0.02


def test_awkward_rows(spark):
    got = {(r["doc_id"], r["text"]): r for r in X.score(docs(spark), LEXICON).collect()}
    floor = LEXICON.score(0.0)
    for key in ((2, None), (3, ""), (4, " \t\n "), (None, "alpha beta gamma delta epsilon")):
        assert got[key]["score"] == floor and got[key]["predicted"] == 0
    assert X.score(docs(spark), LEXICON, keep=["doc_id"]).count() == 10 and X.score(empty(spark), LEXICON).count() == 0


def test_labels_with_nulls_repeats_and_none_toxic(spark):
    df = docs(spark, [(k, "you idiot fool" if k % 2 else "kind gentle word") for k in range(40)])
    schema = "doc_id bigint, toxic int, label string"
    rows = [(k, k % 2, "x") for k in range(40)] + [(None, 1, "x"), (3, None, "x"), (2, 0, "x"), (1, 0, "x"), (999, 1, "x")]
    lexicon = X.fit(df, spark.createDataFrame(rows, schema))
    assert {" idiot ", " fool ", " you "} <= set(lexicon.weights)
    got = X.score(df, lexicon, keep=["doc_id"]).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got)
    for bare in ([], [(k, 0, "x") for k in range(40)]):
        flat = X.fit(df, spark.createDataFrame(bare, schema))
        assert not flat.weights and {r["predicted"] for r in X.score(df, flat, keep=["doc_id"]).collect()} == {0}


def test_sample_bound_is_kept(spark):
    df = docs(spark, [(k, "word") for k in range(2000)])
    labels = df.select("doc_id", F.lit(1).alias("toxic"))
    n = X.labelled_texts(df, labels, "doc_id", "text", "toxic", 200).count()
    assert 100 < n < 300


def test_stage_keeps_clean_documents_and_columns(spark):
    df = docs(spark, [(1, "you idiot trash idiot"), (2, "a fine day"), (3, None)])
    left = X.drop_toxic(df, LEXICON)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3]
    assert {r["score"] for r in left.collect()} == {"own"}
