"""Toxicity: weighted lexicon, matched by an Aho-Corasick automaton on folded text.

Folding: compatibility forms and case, homoglyphs to Latin letters, digits and
signs that stand for letters (inside words only), invisible characters away,
everything else that is no letter becomes one space.  Lexicon entries are
whole words or word beginnings with a weight (smoothed log-odds of toxic
against other labelled documents); matches inside an exception phrase do not
count.  The summed weight is normalised by length and calibrated to a
probability.  Model data that reach the driver are bounded: at most
``lexicon_size`` entries and one count per calibration bin.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.batches import append_columns, col, map_batches, slices

# Characters that look like a Latin letter, and signs used in its place.
HOMOGLYPHS = {"a": "аα", "b": "вβ", "c": "сϲ", "e": "еε", "h": "һ", "i": "іιı", "j": "ј", "k": "кκ", "m": "м",
              "n": "пη", "o": "оοσ", "p": "рρ", "s": "ѕ", "t": "тτ", "u": "υ", "v": "ν", "w": "ѡω", "x": "хχ", "y": "уγ"}
#: ``ELSE`` holds the other letter of a sign that stands for two.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
ELSE = {"1": "l", "|": "i", "!": "l"}
INVISIBLE = "­​‌‍⁠﻿"
# Harmless phrases around words that are insults on their own.
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "trash bag", "clown fish", "class clown", "sore loser", "idiot proof")

FOLD = {ord(c): k for k, v in HOMOGLYPHS.items() for c in v} | {ord(c): None for c in INVISIBLE}
SIGN_FOLD = str.maketrans(SIGNS)
ELSE_FOLD = str.maketrans(SIGNS | ELSE)
LETTERS = re.compile(r"[^\W\d_]+")
SIGN = re.compile(r"[0-9@$!|]")
#: Signs inside a token of letters; those at its end are punctuation.
TRAILING = re.compile(r"[^\w@$|]+$|[@$!|]+$")
KNOWN_TOKENS = 300_000
KNOWN_PATTERNS = 500_000


def fold(token: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Folded words of a token without white space, and the same words with the other letter of each sign that stands for two."""
    plain = token.strip(".,;:?\"'()")
    if plain.isascii() and plain.isalpha():
        return ((plain.lower(),),) * 2
    s = unicodedata.normalize("NFKC", token).lower().translate(FOLD)
    if not SIGN.search(s):
        return (tuple(LETTERS.findall(s)),) * 2
    parts = [TRAILING.sub("", p) for p in re.split(r"[^\w@$!|]+", s)]
    first, other = (" ".join(p.translate(signs) if LETTERS.search(p) else "" for p in parts) for signs in (SIGN_FOLD, ELSE_FOLD))
    return tuple(LETTERS.findall(first)), tuple(LETTERS.findall(other))


def readings(text: bytes | None, known: dict | None = None) -> tuple[list[str], list[str]]:
    """Folded words of the text in both readings, which have the same lengths; null has none.

    ``known`` remembers tokens, a bounded number of them.
    """
    if not text:
        return [], []
    known = {} if known is None else known
    first: list[str] = []
    other: list[str] = []
    for token in text.decode("utf-8", "replace").split():
        words = known.get(token)
        if words is None:
            if len(known) >= KNOWN_TOKENS:
                known.clear()
            words = known[token] = fold(token)
        first += words[0]
        other += words[1]
    return first, other


def words_of(text: bytes | None, known: dict | None = None) -> list[str]:
    """Folded words of the text (first reading); null has none."""
    return readings(text, known)[0]


def outside(places: list[int], spans: list[tuple[int, int]]) -> list[int]:
    """The places in none of the spans [a, b), by one sweep over both in order."""
    spans = sorted(spans)
    kept, reach, k = [], -1, 0
    for place in sorted(places):
        while k < len(spans) and spans[k][0] <= place:
            reach = max(reach, spans[k][1])
            k += 1
        if place >= reach:
            kept.append(place)
    return kept


@dataclass
class Lexicon:
    """weights: ' word ' (whole) or ' beginning'; the score is 1 / (1 + exp(-(bias + slope * density)))."""
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -5.0
    slope: float = 1.0

    def matcher(self):
        """texts -> (words, matches, density) of each."""
        automaton = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            automaton.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            folded = f" {' '.join(words_of(phrase.encode()))} "
            if folded.strip():
                automaton.add_word(folded, (len(folded), None))
        if len(automaton):
            automaton.make_automaton()

        known: dict = {}

        def one(text: bytes | None) -> tuple[int, int, float]:
            words, other = readings(text, known)
            if not words or not len(automaton):
                return len(words), 0, 0.0
            at: dict[int, float] = {}
            spared: list[tuple[int, int]] = []
            for reading in (words,) if other == words else (words, other):
                for end, (size, weight) in automaton.iter(f" {' '.join(reading)} "):
                    start = end + 1 - size
                    if weight is None:
                        spared.append((start, end))
                    else:
                        at[start] = max(weight, at.get(start, 0.0))
            found = [at[place] for place in outside(list(at), spared)]
            return len(words), len(found), math.log1p(100 * math.fsum(found) / (len(words) + 50))
        return one

    def score(self, density: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.slope * density))))


# --- learning -------------------------------------------------------------------------------

def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """(text, label) of at most about ``max_labelled`` labelled ids, chosen by a hash of the id.

    An id labelled more than once counts once (its highest label); null ids
    and null labels are passed over.  The bound makes the label side small
    enough to broadcast.
    """
    ids = (labels.filter(col(label_col).isNotNull() & col(id_col).isNotNull())
           .groupBy(col(id_col).alias("__id")).agg(F.max(col(label_col).cast("int")).alias("label")))
    n = ids.count()
    if n > max_labelled:
        ids = ids.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int((1 << 30) * max_labelled / n))
    return docs.select(col(id_col).alias("__doc"), col(text_col).alias("text")) \
        .join(F.broadcast(ids), F.col("__doc") == F.col("__id")).select("text", "label")


def count_patterns(texts: DataFrame, prefixes: tuple[int, ...]) -> DataFrame:
    """(pattern, toxic, clean): labelled documents with the word or word beginning; summed in each task (a bounded number of
    patterns at a time) before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        seen = (Counter(), Counter())

        def counted() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[1][x] for x in names], pa.int64()),
                 pa.array([seen[0][x] for x in names], pa.int64())], names=["pattern", "toxic", "clean"])
            seen[0].clear()
            seen[1].clear()
            return out

        for batch in batches:
            for piece in slices(batch, 0, 8 << 20):
                for text, label in zip(piece.column(0).cast(pa.binary()).to_pylist(), piece.column(1).to_pylist()):
                    words = {w for w in words_of(text, known) if len(w) > 2}
                    seen[label > 0].update(f" {w} " for w in words)
                    for k in prefixes:
                        seen[label > 0].update({f" {w[:k]}" for w in words if len(w) >= k})
                if len(seen[0]) + len(seen[1]) >= KNOWN_PATTERNS:
                    yield counted()
        yield counted()

    return (map_batches(texts, run, "pattern string, toxic bigint, clean bigint")
            .groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def choose(candidates: list[tuple[str, int, float]], gain: float = 1.15) -> dict[str, float]:
    """Entries from (pattern, toxic documents, log-odds): a beginning only where it gains on its best extension."""
    support = {p: n for p, n, _ in candidates}
    longest: dict[str, int] = {}
    for p, n in support.items():
        word = p.rstrip(" ")
        for k in range(2, len(word) + (p != word)):
            longest[word[:k]] = max(longest.get(word[:k], 0), n)
    kept: dict[str, float] = {}
    for p, n, odds in sorted(candidates, key=lambda c: (len(c[0]), c[0])):
        word = p.rstrip(" ")
        if any(word[:k] in kept for k in range(2, len(word) + (p != word))):
            continue
        if p == word and n < gain * longest.get(word, 0):
            continue
        kept[p] = odds
    return kept


def calibrate(bins: list[tuple[float, int, int]], ridge: float = 1.0) -> tuple[float, float]:
    """Logistic bias and slope from (density, label, documents) by Newton steps."""
    x = np.array([[1.0, b[0]] for b in bins]).reshape(-1, 2)
    y, n = np.array([b[1] for b in bins], float), np.array([b[2] for b in bins], float)
    w, keep = np.zeros(2), np.diag([1e-3, 1e-3]) * ridge
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + keep, x.T @ (n * (y - p)) - keep @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_labelled: int = 200_000, lexicon_size: int = 2000, min_odds: float = 3.5, prefixes: tuple[int, ...] = (3, 4, 5, 6, 7, 8),
        exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learn the lexicon and its calibration from labelled documents (``max_labelled`` of them at most).

    Without any toxic or any other label the lexicon is empty and every score
    is near 0.
    """
    texts = labelled_texts(docs, labels, id_col, text_col, label_col, max_labelled)
    size = {int(r["label"] > 0): r["count"] for r in texts.groupBy((F.col("label") > 0).cast("int").alias("label")).count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Lexicon(exceptions=exceptions)
    odds = F.log((F.col("toxic") + 0.5) / toxic * clean / (F.col("clean") + 0.5))
    found = (count_patterns(texts, prefixes).filter(F.col("toxic") >= max(4, round(0.002 * toxic))).withColumn("odds", odds)
             .filter(F.col("odds") >= min_odds)
             .orderBy(F.desc("odds"), F.desc("toxic"), "pattern").limit(5 * lexicon_size).collect())
    weights = choose([(r["pattern"], r["toxic"], r["odds"]) for r in found])
    lexicon = Lexicon(dict(sorted(weights.items(), key=lambda w: (-w[1], w[0]))[:lexicon_size]), exceptions)
    bins = (measure(texts, lexicon, "text", ["label"]).groupBy(F.round("density", 2).alias("x"), (F.col("label") > 0).cast("int").alias("y"))
            .count().collect())  # one row per hundredth of log density and label
    lexicon.bias, lexicon.slope = calibrate([(r["x"], r["y"], r["count"]) for r in bins])
    return lexicon


# --- scoring --------------------------------------------------------------------------------

def measure(df: DataFrame, lexicon: Lexicon, text_col: str, keep: list[str] | None) -> DataFrame:
    def make():
        one = lexicon.matcher()

        def work(texts: list[bytes | None]) -> list:
            rows = [one(t) for t in texts]
            density = [r[2] for r in rows]
            return [[r[0] for r in rows], [r[1] for r in rows], density, [lexicon.score(d) for d in density]]
        return work
    fields = [("n_words", "bigint"), ("n_matches", "bigint"), ("density", "double"), ("score", "double")]
    return append_columns(df, text_col, make, fields, keep=keep)


def score(df: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """Append n_words, n_matches, density, score (0 to 1) and predicted (1 if score >= threshold) to each row.

    Null and empty texts have no match and the score of a text without one.
    Input columns named like a result give way; repeated rows are scored each;
    an empty table stays empty.
    """
    return measure(df, lexicon, text_col, keep).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents (all columns) that are not predicted toxic.

    Null and empty texts have no match and stay; repeated rows are judged each; any column names are kept; an empty table stays empty.
    """
    ours = {"n_words", "n_matches", "density", "score", "predicted"}
    clash = {n: f"__own_{n}" for n in docs.columns if n.lower() in ours}
    out = score(docs.withColumnsRenamed(clash), lexicon, text_col, threshold).filter("predicted = 0")
    return out.select(*[col(clash.get(n, n)).alias(n) for n in docs.columns])
