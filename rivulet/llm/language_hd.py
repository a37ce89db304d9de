"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector, drawn from a generator seeded by its
code point, so no alphabet is fixed or learned.  The vector of a three-letter
gram binds (multiplies) the letters' vectors, permuted by their distance from
the end: roll(roll(a) * b) * c.  A document bundles (sums) the vectors of its
grams, by a matrix product of gram counts and gram vectors; a language's
prototype sums the unit vectors of its documents.  Documents go to the
prototype of largest cosine.

Learning is one narrow pass: each slice of texts adds its vectors into one row
per language, so a handful of vectors per slice are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.batches import append_columns, col, map_batches, slices

DIMENSIONS = 1024
UNKNOWN = "und"


class Space:
    """Letter and gram vectors, kept per task."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            rng = np.random.default_rng([self.seed, code])
            self.letters[code] = (rng.integers(0, 2, self.dimensions) * 2 - 1).astype(np.int8)
        return self.letters[code]

    def bundles(self, texts: list[bytes | None], rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, letters): one bundled vector per text and how many letters it has."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        letters = np.zeros(len(texts), np.int64)
        for a in range(0, len(texts), rows):
            self._bundle(texts[a:a + rows], out[a:a + rows], letters[a:a + rows])
        return out, letters

    def vectors(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """``bundles``; a text whose letters give no gram (a letter alone at its start) gets the gram of a break before it."""
        out, letters = self.bundles(texts)
        bare = np.flatnonzero((letters > 0) & ~out.any(axis=1))
        if len(bare):
            out[bare] = self.bundles([b" " + texts[k] for k in bare])[0]
        return out, letters

    def _bundle(self, texts: list[bytes | None], out: np.ndarray, letters: np.ndarray) -> None:
        # one string; every text ends with two breaks, which keep grams apart
        lowered = [t.decode("utf-8", "replace").lower() if t else "" for t in texts]
        codes = np.frombuffer("\n\n".join([*lowered, ""]).encode("utf-32-le"), "<u4")
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.array([len(t) + 2 for t in lowered]))
        code, used = compact(codes)
        is_letter = np.array([chr(c).isalpha() for c in used], bool)
        # all that is no letter is one symbol, the space, and a run of it one place
        alphabet = np.concatenate(([32], used[is_letter]))
        symbol = np.zeros(len(used), np.int64)
        symbol[is_letter] = np.arange(1, len(alphabet))
        code = symbol[code]
        at_letter = code > 0
        letters += np.bincount(owner, at_letter, len(texts)).astype(np.int64)
        keep = at_letter.copy()
        keep[0] = True
        keep[1:] |= at_letter[:-1] | (owner[1:] != owner[:-1])
        code, owner, n = code[keep], owner[keep], len(alphabet)
        if len(code) < 3:
            return
        whole = owner[:-2] == owner[2:]
        gram, kinds = compact(((code[:-2] * n + code[1:-1]) * n + code[2:])[whole])
        owner = owner[:-2][whole].astype(np.int64)
        table = np.stack([self.letter(int(c)) for c in alphabet])
        first, second = np.roll(table, 2, axis=1), np.roll(table, 1, axis=1)
        per = max(256, (48 << 20) // (4 * max(len(texts), self.dimensions)))
        if len(kinds) > per:  # blocks of gram kinds, so that counts and vectors stay small
            order = np.argsort(gram, kind="stable")
            gram, owner = gram[order], owner[order]
        for lo in range(0, len(kinds), per):
            part = kinds[lo:lo + per]
            a, b = (0, len(gram)) if len(kinds) <= per else np.searchsorted(gram, [lo, lo + len(part)])
            counts = np.bincount(owner[a:b] * len(part) + gram[a:b] - lo, minlength=len(texts) * len(part))
            vectors = (first[part // (n * n)] * second[part // n % n] * table[part % n]).astype(np.float32)
            out += counts.reshape(len(texts), len(part)).astype(np.float32) @ vectors


def compact(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of each value among the distinct ones, the distinct values in order); by counting where they are dense."""
    top = int(values.max()) + 1 if len(values) else 0
    if top > max(1 << 21, 4 * len(values)):
        kinds, index = np.unique(values, return_inverse=True)
        return index, kinds
    seen = np.bincount(values, minlength=top) > 0
    return (np.cumsum(seen) - 1)[values], np.flatnonzero(seen)


@dataclass
class Profiles:
    """Unit prototypes by language; ``seed`` and the vectors' length fix the letters' vectors."""
    languages: list[str]
    prototypes: np.ndarray
    dimensions: int = DIMENSIONS
    seed: int = 7

    def predictor(self):
        space = Space(self.dimensions, self.seed)

        def work(texts: list[bytes | None]) -> list:
            vectors, letters = space.vectors(texts)
            size = np.linalg.norm(vectors, axis=1)
            cosine = vectors @ self.prototypes.T / np.maximum(size, 1e-9)[:, None] if self.languages else np.zeros((len(texts), 0))
            known = (letters > 0) & (size > 0) & bool(self.languages)
            best = cosine.argmax(axis=1) if self.languages else np.zeros(len(texts), int)
            top = cosine.max(axis=1) if self.languages else np.zeros(len(texts))
            return [[self.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
                    np.where(known, np.clip(top, 0, 1), 0).astype(np.float64), letters]
        return work


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", where: Column | None = None,
          dimensions: int = DIMENSIONS, seed: int = 7) -> Profiles:
    """Prototypes from all documents with a text and a language (and ``where`` true)."""
    labelled = docs.filter(col(text_col).isNotNull() & col(lang_col).isNotNull() & (F.lit(True) if where is None else where)) \
        .select(col(text_col).cast("string").alias("text"), col(lang_col).cast("string").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(dimensions, seed), {}
        for batch in batches:
            for piece in slices(batch, 0, 4 << 20):
                vectors, _ = space.vectors(piece.column(0).cast(pa.binary()).to_pylist())
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
                langs = np.array(piece.column(1).to_pylist(), object)
                for lang in set(langs):
                    sums[lang] = sums.get(lang, 0) + vectors[langs == lang].sum(axis=0, dtype=np.float64)
        # fixed-point sums: the total does not depend on the order of addition
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([np.rint(v * 2 ** 20).astype(np.int64) for v in sums.values()],
                                                         pa.list_(pa.int64()))], names=["lang", "v"])

    rows = (map_batches(labelled, run, "lang string, v array<bigint>")
            .select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))  # one entry per dimension
            .collect())  # one row per language
    rows = sorted(rows, key=lambda r: r["lang"])
    vectors = np.array([[e["x"] for e in r["v"]] for r in rows], np.float64).reshape(-1, dimensions)
    size = np.linalg.norm(vectors, axis=1)
    keep = size > 0
    return Profiles([r["lang"] for r, k in zip(rows, keep) if k],
                    (vectors[keep] / size[keep, None]).astype(np.float32), dimensions, seed)


def identify(df: DataFrame, profiles: Profiles, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append lang_pred, score (cosine with its prototype, 0 to 1) and n_letters to each row.

    ``und`` with score 0 where the text is null or has no letter, or nothing
    was learned.  Equal cosines go to the first language by name.  Input
    columns named like a result give way; repeated rows are scored each; an
    empty table stays empty.
    """
    return append_columns(df, text_col, profiles.predictor,
                          [("lang_pred", "string"), ("score", "double"), ("n_letters", "bigint")], keep=keep, max_bytes=2 << 20)


def drop_unidentified(docs: DataFrame, profiles: Profiles, text_col: str = "text", min_score: float = 0.25,
                      deviations: float = 3.0) -> DataFrame:
    """The documents (all columns) with a language: a letter, and a cosine no further below ``min_score`` than chance explains.

    The cosine of a text of n letters scatters by about ``1 / sqrt(n)``, so the
    text goes where its cosine is below ``min_score - deviations / sqrt(n)``.  Null, empty and
    letterless texts go; repeated rows are judged each; any column names are kept; an empty table stays empty.
    """
    ours = {"lang_pred", "score", "n_letters"}
    clash = {n: f"__own_{n}" for n in docs.columns if n.lower() in ours}
    out = identify(docs.withColumnsRenamed(clash), profiles, text_col).filter(
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score - deviations / F.sqrt("n_letters")))
    return out.select(*[col(clash.get(n, n)).alias(n) for n in docs.columns])
