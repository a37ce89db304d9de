import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rivulet.llm import collocations as C

SCHEMA = "doc_id bigint, text string, lang string, phrase string, n int, `key.dot` string"


def grams(rows, longest=3):
    f = defaultdict(Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang if lang is not None else "und"][" ".join(words[i:i + k])] += 1
    return f


def brute(rows, min_count=10, longest=3, cover=50, top=2000):
    out = []
    for lang, f in grams(rows, longest).items():
        n = sum(c for p, c in f.items() if " " not in p)
        candidates = {p: a for p, a in f.items() if " " in p and a >= min_count}
        scored = {}
        for p, a in candidates.items():
            w = p.split(" ")
            scored[p] = min((1000000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k, f[" ".join(w[:k])], f[" ".join(w[k:])])
                            for k in range(1, len(w)))
        covered = set()
        for p, a in candidates.items():
            w = p.split(" ")
            for size in range(2, len(w)):
                for i in range(len(w) - size + 1):
                    inner = " ".join(w[i:i + size])
                    if 100 * a >= cover * candidates[inner]:
                        covered.add(inner)
        best = sorted((-s, -candidates[p], p.encode(), l, r) for p, (s, _, l, r) in scored.items() if p not in covered)[:top]
        out += [(lang, k, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(k, t, lang, "own", 5, "own") for k, (t, lang) in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, C.collocations(df, **{"slot_bits": 16, **kw}).collect()))


def sample(seed, n=160, words=60):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["Straße", "élan", "the", "of", "\x00x", "a-b"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(r.randrange(1, 60)):
            text += r.choice([*r.choices(vocabulary, weights), "New  York City", "in SPITE of", "of the"]) + r.choice([" "] * 12 + [". ", ",", "\n", "\t", "; "])
        rows.append((text, r.choice(["en", "en", "de", None])))
    return rows + [("hot line of words", "en")] * 80 + [(None, "en"), ("", "en"), (" .,; ", "de"), ("x", "und"), ("alone word", "fr")]


def test_equals_brute_force(spark):
    rows = sample(1)
    got = run(spark, rows)
    assert got == brute(rows) and any(" york city" in r[2] for r in got)


@pytest.mark.parametrize("kw", [{"slot_bits": 4}, {"shards": 1}, {"shards": 7}])
def test_counts_do_not_depend_on_tables_or_shards(spark, kw):
    rows = sample(2, n=60)
    assert run(spark, rows, **kw) == brute(rows)


def test_longer_phrases_and_other_limits(spark):
    rows = sample(3, n=80)
    assert run(spark, rows, max_words=5, min_count=6, cover_percent=80, top=7) == brute(rows, 6, 5, 80, 7)


def test_rare_until_the_last_shard(spark):
    """Words that reach the threshold late still get every occurrence of their phrases counted, those in earlier shards included."""
    rows = [(f"late pair here {k}", "en") for k in range(12)] + [(f"filler{k} text{k}", "en") for k in range(200)]
    got = {r[2]: r[3] for r in run(spark, rows)}
    assert got == {"late pair here": 12}


def test_empty(spark):
    assert run(spark, []) == []


def test_chunks_carry_words_over():
    text = ("one two three. four five " * 400).encode()
    want, got = Counter(), Counter()
    for size, total in ((10 ** 9, want), (50, got)):
        for tokens, carry in C.chunks(text, 2, size):
            for i, _ in enumerate(tokens):
                for k in (1, 2, 3):
                    gram = tokens[i:i + k]
                    if len(gram) == k and C.END not in gram and i + k > carry:
                        total[b" ".join(gram)] += 1
    assert got == want and want[b"one two three"] == 400


def test_rare_phrases_leave_no_rows_of_their_own(spark, monkeypatch):
    """Phrases of frequent words that are rare themselves are counted as hashes: no table between steps has a row for each."""
    r = random.Random(4)
    rows = [(f"w{r.randrange(200)} w{r.randrange(200)}", "en") for _ in range(20000)] + [("often here", "en")] * 12
    sizes, save = [], C.save_and_reread

    def saved(df, label, **kw):
        out = save(df, label, **kw)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(C, "save_and_reread", saved)
    assert run(spark, rows) == brute(rows)
    assert len([p for p, f in grams(rows)["en"].items() if f < 10]) > 10000 and max(sizes) < 3000


def numbered(text):
    index = C.numbering()
    ids = [index[t] for tokens, _ in C.chunks(text.encode(), 0) for t in tokens]
    return list(index), np.array(ids, np.int32)


def test_texts_are_told_apart_whose_hashes_are_equal(monkeypatch):
    monkeypatch.setattr(C, "mixed", lambda a, b: np.zeros_like(a))
    text = "one two three. four five one two three " * 12
    tables = C.Marks([np.full(256, 255, np.uint8) for _ in range(3)])
    words, ids = numbered(text)
    got = {p.decode(): f for k, phrases, counts in C.count_texts("en", words, ids, np.ones(len(ids), bool), tables) if k for p, f in zip(phrases, counts.tolist())}
    assert got == grams([(text, "en")])["en"]


def test_counts_of_hashes_stop_at_their_maximum(spark):
    """A word found more often than a hash can count, and a threshold above that."""
    rows = [("hot line " * 1000, "en")] * 140 + [("cold line", "en")]
    f = {r.phrase: r.f for r in C.frequent_phrases(spark.createDataFrame([(t, lang) for t, lang in rows], "text string, lang string"),
                                                   min_count=70000, slot_bits=16).filter("n > 0").collect()}
    assert f == {p: n for p, n in grams(rows)["en"].items() if n >= 70000}


@pytest.mark.parametrize("bits", [0, 4, 8, 12])
def test_bits_of_a_part_lie_in_its_block(bits):
    """Both bits lie within the table and in the block that the part's row of bits is for, and the count does not move them."""
    hashes = np.sort(np.random.default_rng(bits).integers(0, 2 ** 63, 5000, dtype=np.uint64) * np.uint64(2))
    size = 8 * (1 << bits >> C.block_bits(1 << bits))
    part = (hashes >> np.uint64(64 - C.PART_BITS)).astype(np.int64)
    for found, other in zip(C.bits_of(hashes, 1 << bits), C.bits_of(hashes | np.uint64(C.MOST), 1 << bits)):
        assert (found == other).all() and found.min() >= 0 and found.max() < 8 << bits
        assert (found // size == part >> (C.PART_BITS - C.block_bits(1 << bits))).all()
        assert len(np.unique(found)) > min(4 << bits, 3000)
