"""Hard negatives by angular triangle filtering.

Every row keeps its integer vector, its norm and its angles to a few reference
directions.  For an anchor at angle ``s`` and a row at angle ``t`` from one
direction, the angle between the two lies in ``[|s - t|, min(s + t, 2 pi - s - t)]``;
the references together give one interval of the cosine, and the two norms turn
it into an interval of the score, widened so that no rounding can hide a pair.
Only pairs whose interval overlaps a window still open are scored, in integers.

Work is dealt in two directions: rows are dealt evenly into parts of bounded
bytes, and anchors (a stated query set) visit each part in blocks.  A part is held by one task
while the anchors stream past it; nothing but a bounded sample, from which the
reference directions are chosen, reaches the driver.  Each part answers with at
most ``k`` rows an open window, which a ranked window merges.

Two passes: the first finds an anchor's positives (same label, no bounds on the
score), the second the negatives of each positive (another label, a score from
``low`` to ``high`` percent of the positive's).

Angles prune as far as the data allow: rows in clusters of another direction go
unscored, vectors spread evenly over a sphere of many dimensions overlap nearly
every window and get scored.  The results are exact either way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivulet.llm.batches import col, map_batches, save_and_reread

#: Rows that the reference directions are chosen from, and how many are chosen.
SAMPLE_ROWS, REFERENCES = 4096, 8
#: Bytes of integer vectors in one part.
PART_BYTES = 32 << 20
#: Anchors and rows that are compared at once, and numbers multiplied at once.
BLOCK, CHUNK, NUMBERS = 64, 4096, 4 << 20
#: Widening of a stored angle (kept as a 32-bit float) in radians.
SLACK = 1e-6
TOP = np.iinfo(np.int64).max

STORED = "id bigint, label string, q binary, norm double, angles binary, anchor boolean"
FOUND = "anchor string, w int, id bigint, score bigint"


def angles_to(q: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of integer vectors (rows of ``q``) to unit directions; a right angle for a zero vector."""
    q = q.astype(np.float64)
    norms = np.sqrt((q * q).sum(1))
    return np.arccos(np.clip(q @ references.T / np.where(norms > 0, norms, 1)[:, None], -1, 1))


def pick_references(q: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Farthest-first directions among the sample's vectors; none for vectors of no length."""
    q = q.astype(np.float64)
    norms = np.sqrt((q * q).sum(1))
    unit = q[norms > 0] / norms[norms > 0][:, None]
    if not len(unit):
        return np.zeros((0, q.shape[1]))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def score_bounds(angles_a: np.ndarray, norms_a: np.ndarray, angles_b: np.ndarray, norms_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers below and above each pair's score."""
    least = np.zeros((len(angles_a), len(angles_b)), np.float32)
    most = np.full_like(least, math.pi)
    for a, b in zip(angles_a.T, angles_b.T):
        np.maximum(least, np.abs(a[:, None] - b[None]), out=least)
        total = a[:, None] + b[None]
        np.minimum(most, np.minimum(total, np.float32(2 * math.pi) - total), out=most)
    scale = norms_a[:, None] * norms_b[None] * (1 + 1e-12)
    upper = np.cos(np.maximum(least.astype(np.float64) - SLACK, 0)) + 1e-12
    lower = np.cos(np.minimum(most.astype(np.float64) + SLACK, math.pi)) - 1e-12
    return np.floor(scale * lower) - 1, np.ceil(scale * upper) + 1


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with the rows of ``b``, pair by pair; beyond 64 bits they stay at its ends."""
    if not len(a):
        return np.zeros(0, np.int64)
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if largest < 2 ** 53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    exact = [sum(int(x) * int(y) for x, y in zip(r, s)) for r, s in zip(a, b)]
    return np.array([max(-TOP, min(TOP, x)) for x in exact], np.int64)


def scores_of(overlap: np.ndarray, q: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs that overlap.

    Where more than a quarter of the pairs between the anchors and rows concerned overlap, one matrix product of whole numbers
    (exact below 2^53) serves them; else, or for larger numbers, each pair is multiplied by itself.
    """
    a, b = np.nonzero(overlap)
    some_a, some_b = np.flatnonzero(overlap.any(axis=1)), np.flatnonzero(overlap.any(axis=0))
    left, right = q[some_a], rows[some_b].astype(np.float64)
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(q.shape[1], 1)
    if largest < 2 ** 53 and 4 * len(a) > len(some_a) * len(some_b):
        places_a, places_b = np.zeros(overlap.shape[0], np.int64), np.zeros(overlap.shape[1], np.int64)
        places_a[some_a], places_b[some_b] = np.arange(len(some_a)), np.arange(len(some_b))
        return a, b, (left @ right.T)[places_a[a], places_b[b]].astype(np.int64)
    step = max(1, NUMBERS // max(q.shape[1], 1))
    got = [inner_products(q[a[i:i + step]], rows[b[i:i + step]].astype(np.float64)) for i in range(0, len(a), step)]
    return a, b, np.concatenate(got) if got else np.zeros(0, np.int64)


def firsts(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each key, by falling score, then rising id; in that order."""
    order = np.lexsort((ids, -scores, keys))
    sorted_keys = keys[order]
    starts = np.r_[True, sorted_keys[1:] != sorted_keys[:-1]] if len(order) else np.zeros(0, bool)
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(starts, np.arange(len(order)), 0))
    return order[rank < k]


class Part:
    """The rows of one part and one number of dimensions, by label."""

    def __init__(self, ids, null_id, labels, q, norms, angles):
        order = np.argsort(labels, kind="stable")
        self.ids, self.null_id, self.q = ids[order], null_id[order], q[order]
        self.norms, self.angles = norms[order], angles[order]
        names, starts = np.unique(labels[order], return_index=True)
        self.spans = dict(zip(names, zip(starts, [*starts[1:], len(order)])))

    def chunks(self, label: str, same: bool) -> Iterator[tuple[int, int]]:
        start, stop = self.spans.get(label, (0, 0))
        for a, b in [(start, stop)] if same else [(0, start), (stop, len(self.ids))]:
            for at in range(a, b, CHUNK):
                yield at, min(at + CHUNK, b)

    def search(self, label: str, ids: list, q: np.ndarray, norms: np.ndarray, angles: np.ndarray,
               lows: np.ndarray, highs: np.ndarray, same: bool, k: int) -> tuple[np.ndarray, ...]:
        """The first ``k`` rows of each window of anchors of one label: (window, row, score).

        ``lows`` and ``highs`` have a row for each anchor and a column for each window; an empty window has low > high.
        """
        width = lows.shape[1]
        keys = rows = scores = np.zeros(0, np.int64)
        floor = np.where(lows <= highs, lows, TOP).astype(np.float64)  # an open window's least useful score
        ceiling = highs.astype(np.float64)
        for start, stop in self.chunks(label, same):
            lower, upper = score_bounds(angles, norms, self.angles[start:stop], self.norms[start:stop])
            overlap = np.zeros(lower.shape, bool)
            for w in range(width):
                overlap |= (upper >= floor[:, w, None]) & (lower <= ceiling[:, w, None])
            if same:
                for i, own in enumerate(ids):
                    overlap[i] &= (self.ids[start:stop] != own) | self.null_id[start:stop]
            a, b, s = scores_of(overlap, q, self.q[start:stop])
            for w in range(width):
                fits = (s >= lows[a, w]) & (s <= highs[a, w])
                keys = np.concatenate([keys, a[fits] * width + w])
                rows, scores = np.concatenate([rows, start + b[fits]]), np.concatenate([scores, s[fits]])
            best = firsts(keys, scores, np.where(self.null_id[rows], TOP, self.ids[rows]), k)
            keys, rows, scores = keys[best], rows[best], scores[best]
            full = np.flatnonzero(np.bincount(keys, minlength=len(q) * width) >= k)
            worst = np.full(len(q) * width, -np.inf)
            last = np.r_[keys[1:] != keys[:-1], True] if len(keys) else np.zeros(0, bool)
            worst[keys[last]] = scores[last]
            closed = np.full(len(q) * width, -np.inf)
            closed[full] = worst[full]
            floor = np.maximum(floor, closed.reshape(len(q), width))
        return keys, rows, scores


def matrix(values: pa.Array, dtype) -> np.ndarray:
    """One row for each value; all have the same length."""
    raw = values.to_pylist()
    return np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1) if raw else np.zeros((0, 0), dtype)


def stream(same: bool, k: int):
    """A function over batches sorted by (part, kind): rows (kind 0) are held, anchors (kind 1) are answered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, groups = None, [], None

        def grouped() -> dict[int, Part]:
            table = pa.Table.from_batches(held) if held else None
            out: dict[int, Part] = {}
            if table is None:
                return out
            sizes = np.array([len(x) for x in table["q"].to_pylist()])
            for size in np.unique(sizes):
                t = table.take(np.flatnonzero(sizes == size)).combine_chunks()
                ids = t["id"].combine_chunks()
                out[int(size)] = Part(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                                      np.array(t["label"].to_pylist(), dtype=object).astype(str), matrix(t["q"], "<i4").reshape(t.num_rows, -1),
                                      t["norm"].to_numpy(), matrix(t["angles"], "<f4").reshape(t.num_rows, -1))
            return out

        for batch in batches:
            for start, stop, p, kind in runs(batch):
                piece = batch.slice(start, stop - start)
                if p != part:
                    part, held, groups = p, [], None
                if kind == 0:
                    held.append(piece)
                    continue
                if groups is None:
                    groups, held = grouped(), []
                yield from answers(piece, groups, same, k)

    return run


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
    cuts = np.flatnonzero((parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1])) + 1
    for start, stop in zip([0, *cuts], [*cuts, len(parts)]):
        if stop > start:
            yield int(start), int(stop), int(parts[start]), int(kinds[start])


def answers(anchors: pa.RecordBatch, groups: dict[int, Part], same: bool, k: int) -> Iterator[pa.RecordBatch]:
    rows = anchors.select(["id", "label", "q", "norm", "angles", "anchor", "lows", "highs"]).to_pylist()
    rows.sort(key=lambda r: (len(r["q"]), r["label"]))
    at = 0
    while at < len(rows):
        size, label = len(rows[at]["q"]), rows[at]["label"]
        block = [r for r in rows[at:at + BLOCK] if len(r["q"]) == size and r["label"] == label]
        at += len(block)
        if size not in groups:
            continue
        width = max(len(r["lows"]) for r in block)
        lows, highs = np.ones((len(block), width), np.int64), np.zeros((len(block), width), np.int64)
        for i, r in enumerate(block):
            lows[i, :len(r["lows"])], highs[i, :len(r["highs"])] = r["lows"], r["highs"]
        group = groups[size]
        q = np.frombuffer(b"".join(r["q"] for r in block), "<i4").reshape(len(block), -1).astype(np.float64)
        angles = np.frombuffer(b"".join(r["angles"] for r in block), "<f4").reshape(len(block), -1)
        own = [r["id"] for r in block]
        keys, found, scores = group.search(label, own, q, np.array([r["norm"] for r in block]), angles, lows, highs, same, k)
        ids = pa.array(group.ids[found], mask=group.null_id[found], type=pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([block[i]["anchor"] for i in keys // width], pa.string()),
                                          pa.array(keys % width, pa.int32()), ids, pa.array(scores, pa.int64())],
                                         names=["anchor", "w", "id", "score"])


def stored_rows(rows: DataFrame, scale: int) -> DataFrame:
    """Integer vector, norm and reference angles of every row that takes part, written once."""
    sample = rows.orderBy(F.xxhash64("id", "v"), F.col("id")).limit(SAMPLE_ROWS).select("v").toPandas()["v"]
    by_size: dict[int, list] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(np.floor(np.asarray(v, np.float64) * scale))
    references = {n: pick_references(np.array(v).reshape(len(v), n)) for n, v in by_size.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v")
            sizes = vectors.value_lengths().to_numpy()
            for size in np.unique(sizes):
                b = batch.take(pa.array(np.flatnonzero(sizes == size)))
                q = np.floor(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, size) * scale)
                fits = (np.abs(q) < 2 ** 31).all(1)
                b, q = b.filter(pa.array(fits)), q[fits].astype("<i4")
                angles = angles_to(q, references.get(int(size), np.zeros((0, size)))).astype("<f4")
                norms = np.sqrt((q.astype(np.float64) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("label"), pa.array([r.tobytes() for r in q], pa.binary()), pa.array(norms, pa.float64()),
                     pa.array([r.tobytes() for r in angles], pa.binary()), b.column("anchor")],
                    names=["id", "label", "q", "norm", "angles", "anchor"])

    stored = map_batches(rows.select("id", "label", "v", "anchor"), run, STORED)
    # the number deals equal rows evenly; it is written, so later passes see the same one
    return save_and_reread(stored.withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "negatives-stored")


def visit(stored: DataFrame, anchors: DataFrame, parts: int, same: bool, k: int) -> DataFrame:
    """Every anchor (with its windows) meets every part: the first ``k`` rows of each window over all parts."""
    none = F.array().cast("array<bigint>")
    held = stored.select(F.pmod("deal", F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "id", "label", "q", "norm", "angles",
                         F.lit("").alias("anchor"), none.alias("lows"), none.alias("highs"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"), "id", "label", "q", "norm",
                           "angles", "anchor", "lows", "highs")
    dealt = held.unionByName(asked).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")
    found = map_batches(dealt, stream(same, k), FOUND)
    order = W.partitionBy("anchor", "w").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """Hard negatives of each anchor and positive.

    A component ``x`` becomes ``floor(scale * x)``; scores are integer inner
    products, higher first, ties by smaller id.  Positives: the anchor's first
    rows of its label and of another id.  Negatives: the first rows of another label
    with ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    Rows with a null label, a null vector, a null or non-finite component, or a
    component of 2^31 or more after scaling take no part.  Ids are whole numbers; a row without an id
    can be found (last among ties) but is no anchor.  Vectors of another number of
    dimensions than the anchor's are not compared with it; a vector without components scores 0.  Rows that repeat
    an id or a whole row count each for themselves; anchors that are equal in id, label and
    vector are one anchor.  Scores beyond 64 bits stay at its ends.
    Other columns are ignored.  An empty table gives no rows.

    Returns anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score.
    """
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    given = (rows.select(col(id_col).cast("bigint").alias("id"), col(label_col).cast("string").alias("label"),
                         col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
             .filter(F.col("label").isNotNull() & F.col("v").isNotNull() & finite))
    stored = stored_rows(given, scale)
    size = stored.agg(F.sum(F.length("q") + F.length("angles") + 64)).first()[0] or 0
    parts = max(stored.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))

    anchors = (stored.filter(F.col("anchor") & F.col("id").isNotNull()).select("id", "label", "q", "norm", "angles").distinct()
               .withColumn("anchor", F.sha2(F.concat_ws("|", F.col("id"), F.hex("q"), F.col("label")), 256)))
    everything = anchors.withColumn("lows", F.array(F.lit(-TOP))).withColumn("highs", F.array(F.lit(TOP)))
    near = visit(stored, everything, parts, True, positives)
    hundredths = lambda s, percent: F.lit(percent).cast("decimal(5,0)") * s.cast("decimal(20,0)")
    windows = near.select(
        "anchor", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(hundredths(F.col("score"), low) / 100).cast("bigint").alias("low"),
        F.floor(hundredths(F.col("score"), high) / 100).cast("bigint").alias("high"))
    windows = save_and_reread(windows, "negatives-windows")
    listed = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("w", "low", "high"))).alias("l"))
    asked = anchors.join(listed, "anchor").withColumn("lows", F.col("l.low")).withColumn("highs", F.col("l.high"))
    far = visit(stored, asked, parts, False, negatives).select("anchor", "w", F.col("id").alias("negative_id"), "rank",
                                                               F.col("score").alias("negative_score"))
    return (windows.select("anchor", "w", "positive_id", "positive_score").join(far, ["anchor", "w"])
            .join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
