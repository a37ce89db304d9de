import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from rivulet.llm import simhash_tiles as S

from .cases import AWKWARD, docs, empty


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bits=2):
    prints = [(i, brute_print(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= bits:
                root[find(a)] = find(b)
    out = []
    for a, (i, p) in enumerate(prints):
        ids = [prints[b][0] for b in range(len(rows)) if find(b) == find(a) and prints[b][0] is not None]
        out.append((i, f"{p:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.withColumn("fingerprint", S.fingerprint_hex()).collect()), key=repr)


def near_copies(seed=3, bases=6, copies=25):
    r = random.Random(seed)
    rows, k = [], 100
    for _ in range(bases):
        words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(r.choice([40, 300]))]
        for _ in range(copies):
            w = list(words)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = "edit%d" % r.randrange(9)
            rows.append((k, " ".join(w)))
            k += 1
    return rows


def test_components_equal_brute_force_with_awkward_rows(spark):
    rows = AWKWARD + near_copies()
    assert result(S.simhash_components(docs(spark, rows))) == brute_components(rows)


def test_hot_groups_cut_into_tiles_lose_no_link(spark):
    rows = near_copies(seed=5, bases=2, copies=60)
    assert result(S.simhash_components(docs(spark, rows), tile_rows=5)) == brute_components(rows)


def test_tiles_of_a_hot_value_are_bounded_and_cover_all_close_pairs(spark):
    r = random.Random(1)
    base = r.getrandbits(64)
    prints = sorted({base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(300)})
    signed = [int(np.array([p], np.uint64).view(np.int64)[0]) for p in prints]
    tiles = S.tile_rows_of(spark.createDataFrame([(p,) for p in signed], "fp bigint"), "fp", 2, 3, 20)
    groups = {}
    for t in tiles.collect():
        groups.setdefault(tuple(t)[:6], []).append((t["side"], t["fp"]))
    assert max(map(len, groups.values())) <= 2 * 20 + 40  # two tiles, hash split
    pairs = set()
    for g, members in groups.items():
        two = any(s for s, _ in members)
        pairs |= {frozenset((a, b)) for s, a in members for t, b in members if a != b and (not two or s != t)}
    close = {frozenset((a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2}
    assert close <= pairs
    root = {n: r for n, r in S.connected_components(S.link_tiles(tiles, 2)).collect()}
    linked = {x for p in close for x in p}
    assert set(root) | set(root.values()) == linked


def test_link_runs_equal_pairs():
    r = np.random.default_rng(2)
    for size, bits in ((5, 6), (200, 8), (700, 12)):
        fp = np.unique(r.integers(0, 1 << bits, size).astype(np.uint64))
        fp = fp[np.argsort(np.bitwise_count(fp), kind="stable")]
        n = len(fp)
        label = S.link_runs(np.zeros(n, int), np.zeros(n, int), np.bitwise_count(fp).astype(int), fp, 1, tile=32, short=8)
        for a in range(n):
            for b in range(a):
                if int(fp[a] ^ fp[b]).bit_count() <= 1:
                    assert label[a] == label[b]


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7)]
    got = dict(map(tuple, S.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(1, 201)}, **{k: 1000 for k in range(1001, 1100)}}


def test_block_count_grows_with_the_table():
    assert S.block_count(1000, 2) == 3 and S.block_count(10 ** 10, 2) > 3
    for blocks in (3, 4, 5):
        for x, y in ((0, 0), (1, 63)):
            assert any(((1 << x) | (1 << y)) & m == 0 for m in S.masks(blocks, 2))


def test_empty_table(spark):
    assert S.simhash_components(empty(spark)).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = AWKWARD + near_copies(bases=2, copies=5)
    df = docs(spark, rows)
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    least = {c for _, _, c in brute_components(rows)}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids) == sorted(least)
    assert S.drop_near_duplicates(df.filter("doc_id = 6")).count() == 1
    assert S.drop_near_duplicates(empty(spark)).collect() == []


def test_rows_that_share_an_id_or_have_none_are_judged_by_their_texts(spark):
    """Only copies go: a row stays where another row of its id is a copy, and copies without ids are dropped too."""
    a, b, c, d = ("one text about rivers and their many bends", "quite another thing altogether told here", "a third story of bread and salt",
                  "words nobody else has written down yet")
    rows = [(1, a), (5, a), (5, b), (7, c), (None, d), (None, d), (None, a), (9, b), (9, b)]
    got = sorted(((r["doc_id"], r["text"]) for r in S.drop_near_duplicates(docs(spark, rows, "__row0 string, fingerprint string")).collect()), key=repr)
    assert got == sorted([(1, a), (5, b), (7, c), (None, d)], key=repr)


def test_bit_sums_do_not_depend_on_the_chunk():
    text = (" ".join(f"w{i % 977}" for i in range(5000))).encode()
    assert S.fingerprints_of([text, b"a b", None], 3, rows=64).tolist() == S.fingerprints_of([text, b"a b", None], 3).tolist()
    assert int(S.fingerprints_of([text], 3)[0]) == brute_print(text.decode())


def test_hex_has_sixteen_digits(spark):
    got = spark.createDataFrame([(-1,), (15,)], "fingerprint bigint").select(S.fingerprint_hex().alias("h")).orderBy(F.desc("h")).collect()
    assert [r["h"] for r in got] == ["f" * 16, "0" * 15 + "f"]
