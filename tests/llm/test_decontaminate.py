import hashlib
import random
import re

import numpy as np
import pytest

from rivulet.llm import decontaminate as D

from .cases import AWKWARD, docs, empty

BENCH = "item_id bigint, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, window=10):
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            if item is None or t is None:
                continue
            v = words(t)
            for k in range(max(1, len(v) - window + 1) if v else 0):
                p = v[k:k + window]
                for a in range(len(w) - len(p) + 1):
                    if w[a:a + len(p)] == p:
                        hit.update(range(a, a + len(p)))
                        found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def sample(seed=4):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(12)]
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.choice([3, 9, 10, 14, 30])))) for k in range(12)]
    items += [(3, items[4][1]), (90, items[5][1]), (91, ""), (92, None), (None, "w1 w2 w3"), (93, "one"), (94, "Ünïcode straße")]
    rows = list(AWKWARD)
    for k in range(100, 140):
        parts = []
        for _ in range(r.randint(1, 6)):
            item = words(r.choice(items)[1])
            a = r.randrange(len(item) + 1)
            parts += item[a:a + r.randint(5, 25)] + [r.choice(vocab + ["rare", "Other."])] * r.randint(0, 2)
        rows.append((k, ", ".join(parts)))
    return rows, items


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 30_000])
def test_equals_brute_force_in_one_or_many_phrase_blocks(spark, block_bytes):
    rows, items = sample()
    bench = spark.createDataFrame(items, BENCH).repartition(2)
    got = D.contamination(docs(spark, rows), bench, keep=["doc_id"], block_bytes=block_bytes)
    assert result(got) == brute(rows, items)


def test_spans_cover_the_hit_words(spark):
    item = " ".join(f"q{k}" for k in range(12))
    got = D.contamination(docs(spark, [(1, f"before it, {item.upper()} after"), (2, "nothing")]),
                          spark.createDataFrame([(5, item)], BENCH), keep=["doc_id"]).orderBy("doc_id").collect()
    assert (got[0]["span_starts"], got[0]["span_ends"], got[0]["items"]) == ([2], [14], ["5"])
    assert got[1]["span_starts"] == [] and not got[1]["contaminated"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], BENCH)
    assert result(D.contamination(empty(spark), spark.createDataFrame([(1, "a b")], BENCH), keep=["doc_id"])) == []
    assert result(D.contamination(docs(spark), none, keep=["doc_id"])) == brute(AWKWARD, [])


def test_clean_documents_keep_all_columns(spark):
    df = docs(spark, [(1, "alpha beta"), (2, "gamma")])
    left = D.drop_contaminated(df, spark.createDataFrame([(1, "alpha beta")], BENCH))
    assert left.columns == df.columns and [tuple(r) for r in left.collect()] == [(2, "gamma", *["own"] * 5)]


def test_passages_are_cut_and_nothing_else(spark):
    item = "Alpha, beta gamma"
    rows = [(1, "Keep this: ALPHA beta (gamma). And this é!"), (2, "alpha beta"), (3, None), (4, "alpha beta gamma alpha beta gamma"), (5, "")]
    df = docs(spark, rows)
    got = D.remove_passages(df, spark.createDataFrame([(1, item)], BENCH))
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "Keep this: ). And this é!", 2: "alpha beta", 3: None, 4: "", 5: ""}


def test_index_finds_every_place_of_random_phrases():
    r = np.random.default_rng(0)
    for _ in range(30):
        sigma = int(r.integers(2, 6))
        stretches = [r.integers(1, sigma, r.integers(1, 40)) for _ in range(r.integers(1, 8))]
        text = np.concatenate([np.append(s, 0) for s in stretches])
        index = D.FMIndex(text, sigma, sample=int(r.integers(1, 9)))
        lengths = r.integers(1, 5, 20)
        phrases = np.zeros((20, 4), np.int64)
        for k, n in enumerate(lengths):
            phrases[k, 4 - n:] = r.integers(1, sigma, n)
        which, place = index.locate(*index.search(phrases, lengths))
        got = sorted(zip(which.tolist(), place.tolist()))
        exp = sorted((k, a) for k, n in enumerate(lengths) for a in range(len(text) - n + 1)
                     if (text[a:a + n] == phrases[k, 4 - n:]).all())
        assert got == exp


def test_wavelet_ranks():
    r = np.random.default_rng(1)
    s = r.integers(0, 11, 200)
    tree = D.WaveletMatrix(s, 11)
    for c in range(11):
        at = np.arange(201)
        assert (tree.rank(np.full(201, c), at) == [(s[:a] == c).sum() for a in at]).all()
    c, rank = tree.access(np.arange(200))
    assert (c == s).all() and (rank == [(s[:a] == s[a]).sum() for a in range(200)]).all()


def test_any_item_id_is_one_item(spark):
    """Ids with commas and empty ids are counted as they are."""
    text = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([("a,b", text), ("", text), ("c", "else where")], "item_id string, text string")
    got = D.contamination(docs(spark, [(1, f"x {text} y"), (2, "nothing")]), items, keep=["doc_id"]).orderBy("doc_id").collect()
    assert [(r["n_items"], r["items"], r["contaminated"]) for r in got] == [(2, ["", "a,b"], True), (0, [], False)]
    assert got[0]["items_sha256"] == hashlib.sha256(b",a,b").hexdigest()
