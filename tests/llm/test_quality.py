import itertools
import random
import re
import time
from collections import Counter

import numpy as np

from rivulet.llm import quality_crf as Q

from .cases import AWKWARD, docs, empty

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    hit = {j for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def rows_of():
    r = random.Random(9)
    out = list(AWKWARD) + [(50, "a b c\x85d e"), (51, "x\r\n" * 9 + "y"), (52, "é|#\n" * 30), (53, "a b c d e f g h " * 2),
                           (54, "a b c d e f g h i " * 1 + "a b c d e f g h")]
    for k in range(60, 90):
        out.append((k, "".join(r.choice(["a", "b", "c", "dd"]) + r.choice([" ", " ", "\n", "\t", " | "]) for _ in range(r.randint(0, 120)))))
    return out


def test_base_measures_equal_brute_force(spark):
    rows = rows_of()
    got = Q.quality(docs(spark, rows), Q.empty_field(), keep=["doc_id"]).select("doc_id", *NAMES).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_kept_needs_base_and_content(spark):
    got = {r["doc_id"]: r for r in Q.quality(docs(spark), Q.empty_field(), keep=["doc_id"]).collect()}
    assert not got[5]["kept"] and got[5]["base_failed"]  # one word over and over
    assert got[2]["content_share"] == 0.0 and not got[2]["kept"]
    assert Q.quality(empty(spark), Q.empty_field()).count() == 0


def random_field(r):
    return Q.LineField(r.normal(size=3), r.normal(size=2), r.normal(size=(2, 2)))


def weight_of(f, rows, labels):
    s = f.start[labels[0]] + sum(rows[k] @ f.unary for k, y in enumerate(labels) if y)
    return s + sum(f.step[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_equals_exhaustive_search():
    r = np.random.default_rng(0)
    f, sizes = random_field(r), np.array([3, 0, 1, 6, 6, 2])
    rows = r.normal(size=(sizes.sum(), 3))
    got, at = Q.viterbi(f, rows, sizes), 0
    for n in sizes:
        part = rows[at:at + n]
        if n:
            best = max(itertools.product((0, 1), repeat=int(n)), key=lambda y: weight_of(f, part, y))
            assert got[at:at + n].tolist() == list(best)
        at += n


def test_gradient_equals_enumeration():
    r = np.random.default_rng(1)
    f, sizes = random_field(r), np.array([4, 1, 3])
    rows, label = r.normal(size=(8, 3)), r.integers(0, 2, 8)
    got = Q.gradients(f, rows, sizes, label, np.ones(8))

    def likelihood(field):
        total, at = 0.0, 0
        for n in sizes:
            part = rows[at:at + n]
            z = np.logaddexp.reduce([weight_of(field, part, y) for y in itertools.product((0, 1), repeat=int(n))])
            total += weight_of(field, part, label[at:at + n]) - z
            at += n
        return total
    params = [f.unary, f.start, f.step]
    for i, p in enumerate(params):
        for k in np.ndindex(p.shape):
            up, down = [x.copy() for x in params], [x.copy() for x in params]
            up[i][k] += 1e-5
            down[i][k] -= 1e-5
            assert abs((likelihood(Q.LineField(*up)) - likelihood(Q.LineField(*down))) / 2e-5 - got[i][k]) < 1e-4


def test_no_labels_keeps_all_lines(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    field = Q.fit(docs(spark), none)
    assert not field.unary.any()
    odd = spark.createDataFrame([(1, 1), (None, 0), (5, None)], "doc_id bigint, quality int")
    assert not Q.fit(docs(spark), odd).unary.any()


def test_good_documents_stay_and_bad_ones_go(spark):
    df, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    field = Q.fit(df, labels.filter(~held))
    got = Q.quality(df.select("doc_id", "text"), field, keep=["doc_id"]).filter(held).join(labels, "doc_id").collect()
    good, bad = [r for r in got if r["quality"] == 1], [r for r in got if r["quality"] == 0]
    assert len(good) > 60 and all(r["kept"] or r["base_failed"] for r in good)
    assert np.mean([r["kept"] for r in bad]) <= 0.1


def test_training_sees_each_picked_document_once(spark, monkeypatch):
    seen = {}

    def spy(rows, sizes, quality):
        seen.update(rows=len(rows), sizes=sorted(sizes.tolist()), quality=sorted(quality.tolist()))
        return Q.empty_field()
    monkeypatch.setattr(Q, "train", spy)
    texts = [(1, "one line here\nand a second")] * 500 + [(2, "a\nb\nc"), (2, None), (2, ""), (3, "x\n" * 90), (4, "a single line")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id bigint, quality int")
    Q.fit(docs(spark, texts), labels, max_lines=20)
    assert seen == {"rows": 6, "sizes": [1, 2, 3], "quality": [0, 0, 1]}
    Q.fit(docs(spark, texts), labels)
    assert seen == {"rows": 96, "sizes": [1, 2, 3, 90], "quality": [0, 0, 1, 1]}


def test_only_chosen_features_reach_the_driver(spark, monkeypatch):
    frame = type(docs(spark))
    collected, whole = [], frame.collect

    def spy(self):
        rows = whole(self)
        collected.append(sum(len(r["features"]) for r in rows) if "features" in self.columns else 0)
        return rows
    monkeypatch.setattr(frame, "collect", spy)
    texts = [(1, "one line here\nand a second")] * 500 + [(2, "a\nb\nc"), (3, "x\n" * 900)]
    Q.fit(docs(spark, texts), spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, quality int"), max_lines=20)
    assert sum(collected) == 5 * 4 * len(Q.FEATURES)


def test_training_time_does_not_follow_the_longest_document(spark):
    """A labelled text of 100,000 lines gives a bounded run of lines, in chains of bounded length; both labels are trained."""
    rows = [(1, "\n".join(f"A line number {k} of some length, and a full stop." for k in range(100_000)))]
    rows += [(k, "\n".join(["buy now!!! $$$ ###"] * 30)) for k in range(2, 12)] + [(k, "A good sentence stands here alone.\nAnother one follows it.") for k in range(12, 22)]
    labels = spark.createDataFrame([(k, int(k == 1 or k >= 12)) for k in range(1, 22)], "doc_id bigint, quality int")
    began = time.time()
    field = Q.fit(docs(spark, rows), labels)
    assert time.time() - began < 60 and field.unary.any()
    kept = {r["doc_id"]: r["content_share"] for r in Q.quality(docs(spark, rows[:3] + rows[-2:], ""), field, keep=["doc_id"]).collect()}
    assert kept[1] > 0.9 > 0.5 > kept[2] and kept[20] > 0.9


def test_chains_are_cut_and_runs_are_bounded():
    sizes, owner = Q.stretches(np.array([3, 10, 0, 5]), 5)
    assert sizes.tolist() == [3, 5, 5, 5] and owner.tolist() == [0, 1, 1, 3]
    lines = [[k] for k in range(50)]
    run = Q.run_of(lines, b"some text", 7)
    assert len(run) == 7 and run[0] in lines and run == lines[run[0][0]:run[0][0] + 7] and Q.run_of(lines, b"x", 50) == lines
