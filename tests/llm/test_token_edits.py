import random

from rivulet.llm import token_edits as E

from .cases import AWKWARD, docs, empty

SPECIAL = "<|endoftext|>"
BITS = ["'re", " ", "  ", "\n", "x", "12", "é", "'", "l", "l", "!!", "   a", "r", "v", "\t\n "]


def full(count, text):
    return len(count.encode(text))


def test_counts_equal_encoding_again():
    r, count = random.Random(1), E.Counter()
    for k in range(400):
        d = E.Document("".join(r.choice(BITS) for _ in range(r.randint(0, 600))), count)
        assert d.n_tokens == full(count, d.text)
        for _ in range(4):
            inserted = "".join(r.choice(BITS) for _ in range(r.randint(0, 6) if r.random() < .95 else 900))
            a, n = r.randint(-3, len(d.text) + 3), r.choice([0, 0, 1, 3, 40])
            b = min(max(a, 0), len(d.text))
            expected = d.text[:b] + inserted + d.text[b + n:]
            d.edit(a, n, inserted)
            assert d.text == expected and d.n_tokens == full(count, d.text)
            chars, tokens = d.tree.leaves()
            assert sum(chars) == len(d.text) and sum(tokens) == d.n_tokens


def test_special_tokens_are_leaves_of_their_own():
    """Edits make, break and join special tokens; every count equals encoding the whole text again."""
    r, count = random.Random(2), E.Counter()
    assert full(count, f"a {SPECIAL} b") == E.Document(f"a {SPECIAL} b", count).n_tokens == 4
    bits = BITS + [SPECIAL, SPECIAL[:5], SPECIAL[5:], "<", "|", ">", "<|", "!!!!!!!!!!!!!!!!!!!!"]
    for _ in range(600):
        d = E.Document("".join(r.choice(bits) for _ in range(r.randint(0, 500))), count)
        assert d.n_tokens == full(count, d.text) and count.pieces(d.text) == list(count.split(d.text))
        for _ in range(4):
            d.edit(r.randint(0, len(d.text)), r.choice([0, 0, 1, 5, 13]), "".join(r.choice(bits) for _ in range(r.randint(0, 3))))
            assert d.n_tokens == full(count, d.text)


def test_any_column_names(spark):
    names = "doc_id bigint, text string, e string, seq string, edits string, `key.dot` string"
    trees = E.build_trees(spark.createDataFrame([(1, "one two", "own", "own", "own", "own")], names))
    edits = spark.createDataFrame([(1, 1, 0, 0, "zero "), (1, 1, 0, 0, "zero ")], "doc_id bigint, seq int, start bigint, deleted bigint, inserted string")
    got = E.attach_edits(trees, edits)
    assert got.select("e", "seq", "`key.dot`").first() == ("own", "own", "own")
    assert E.apply_edits(got).first()["text"] == "zero zero one two"


def test_only_the_neighbourhood_is_encoded_again():
    count = E.Counter()
    d = E.Document("some words of a long text " * 4000, count)
    d.edit(50_000, 3, "abc")
    assert 0 < d.reencoded < 3000
    d.edit(0, 0, "y")
    d.edit(len(d.text), 0, " z")
    assert d.reencoded < 9000 and d.n_tokens == full(count, d.text)


def test_stored_trees_take_later_edits(spark):
    rows = [(i, t) for i, t in AWKWARD if i is not None] + [(40, "a few words 'twas " * 300)]
    trees = E.build_trees(docs(spark, rows))
    edits = spark.createDataFrame([(40, 2, 10, 4, "new", "own"), (40, 1, 0, 0, "first ", "own"), (2, 1, 0, 0, "born", "own"), (77, 1, 0, 0, "x", "own"),
                                   (None, 1, 0, 0, "x", "own"), (6, 1, None, None, None, "own"), (8, 1, 999, 5, "tail", "own")],
                                  "doc_id bigint, seq int, start bigint, deleted bigint, inserted string, text string")
    once = E.apply_edits(E.attach_edits(trees, edits))
    got = {r["doc_id"]: r for r in once.collect()}
    text = "first " + "a few words 'twas " * 300
    assert got[40]["text"] == text[:10] + "new" + text[14:] and got[40]["n_edits"] == 2
    assert got[2]["text"] == "born" and got[2]["n_tokens_before"] == 0 and got[8]["text"].endswith("xtail")
    count = E.Counter()
    again = E.apply_edits(E.attach_edits(once, edits.filter("doc_id = 40 and seq = 1")))
    for r in list(got.values()) + again.collect():
        assert r["n_tokens"] == full(count, r["text"]) == sum(r["leaf_tokens"])
    assert once.count() == len(rows) and E.apply_edits(E.attach_edits(E.build_trees(empty(spark)), edits)).count() == 0


def test_query_counts_equal_encoding_again(spark):
    from rivulet.llm.queries import QUERIES
    count = E.Counter()
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_token_edits"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["n_tokens_before"] == full(count, texts[r["doc_id"]] or "") and r["n_edits"] == 3
        assert r["reencoded_chars"] <= 3 * 4000


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(E, "CACHED_PIECES", 10)
    count = E.Counter()
    for k in range(100):
        assert count(f" w{k}") == len(count.encode(f" w{k}"))
        assert len(count.known) <= 10
