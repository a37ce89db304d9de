import math
import random

import numpy as np
from pyspark.sql import functions as F

from rivulet.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, id bigint, part int, rank string"


def brute(rows, positives=5, negatives=5, low=80, high=100):
    live = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(object), lab) for i, v, lab in rows
            if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    live = [(i, [int(x) for x in q], lab) for i, q, lab in live]
    anchors = {(i, tuple(q), lab) for i, q, lab in live if i is not None and i % 100 == 0}
    out = []
    for i, q, lab in anchors:
        scored = sorted(((-sum(a * b for a, b in zip(q, p)), math.inf if j is None else j, j, other) for j, p, other in live if len(p) == len(q)),
                        key=lambda t: t[:2])
        near = [(j, -s) for s, _, j, other in scored if other == lab and j != i][:positives]
        for j, p in near:
            fits = [(n, -s) for s, _, n, other in scored if other != lab and low * p <= 100 * -s <= high * p][:negatives]
            out += [(i, j, r, n, p, s) for r, (n, s) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 7, 7, "own") for r in rows], SCHEMA)
    return sorted(map(tuple, H.mine(df, F.col("vec_id") % 100 == 0, **kw).collect()), key=repr)


def sample(seed, n=240, dim=6, spread=0.3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = [(k * 5, [c + r.gauss(0, spread) for c in r.choice(centres)], r.randrange(3)) for k in range(n)]
    hot = [0.5] * dim
    return rows + [(5000 + k, hot, k % 3) for k in range(n // 2)]


def test_equals_brute_force(spark):
    for seed, spread in ((1, 0.3), (2, 0.05)):
        rows = sample(seed, spread=spread)
        got = run(spark, rows)
        assert got == brute(rows) and len(got) > 20


def test_other_numbers(spark):
    rows = sample(3, n=80)
    assert run(spark, rows, positives=2, negatives=3, low=-50, high=90) == brute(rows, 2, 3, -50, 90)


def test_awkward_rows(spark):
    rows = sample(4, n=60) + [(100, None, 1), (200, [0.1] * 6, None), (300, [math.nan] + [0.1] * 5, 1), (400, [math.inf] + [0.1] * 5, 1),
                              (500, [None] + [0.1] * 5, 1), (None, [0.4] * 6, 1), (None, [0.4] * 6, 2), (600, [], 1), (601, [], 1), (602, [], 2),
                              (700, [0.0] * 6, 1), (800, [1.0, 2.0], 1), (801, [1.0, 2.0], 1), (802, [1.0, 1.9], 2),
                              (0, [0.5] * 6, 1), (0, [0.5] * 6, 1), (0, [0.5] * 6, 2), (801, [1.0, 2.0], 1)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[0] for r in got} >= {600, 700, 800}


def test_large_components_are_exact(spark):
    rows = [(0, [3e6, 1e6, 7e5], 0), (1, [3e6, 1e6, 7e5], 0), (2, [3e6, 1e6, 6.9e5], 1), (3, [2.9e6, 1e6, 7e5], 1), (4, [8e6, 8e6, 8e6], 0), (5, [9e9, 1.0, 1.0], 0)]
    got = run(spark, rows)
    assert got == brute(rows[:5])


def test_empty(spark):
    assert run(spark, []) == []


def test_bounds_hold_every_score():
    r = np.random.default_rng(5)
    q = np.floor(r.normal(size=(200, 12)) * 256)
    q[:20] = q[20:40] * 2
    references = H.pick_references(q)
    angles = H.angles_to(q, references).astype(np.float32)
    norms = np.sqrt((q * q).sum(1))
    lower, upper = H.score_bounds(angles, norms, angles, norms)
    scores = q @ q.T
    assert (lower <= scores).all() and (scores <= upper).all()
    assert (np.abs(lower - upper)[:20] < 1e9).all()


def test_bounds_leave_pairs_out():
    """Rows in tight clusters: most pairs of different clusters are never scored."""
    r = np.random.default_rng(6)
    centres = r.normal(size=(6, 16))
    q = np.floor((centres[np.arange(300) % 6] + 0.02 * r.normal(size=(300, 16))) * 256)
    angles = H.angles_to(q, H.pick_references(q)).astype(np.float32)
    norms = np.sqrt((q * q).sum(1))
    _, upper = H.score_bounds(angles, norms, angles, norms)
    same = np.equal.outer(np.arange(300) % 6, np.arange(300) % 6)
    floor = 0.8 * (q @ q.T)[same].min()
    assert (upper >= floor).mean() < 0.5 and (upper[same] >= floor).all()


def test_pairs_are_scored_alike_by_product_and_by_pair():
    r = np.random.default_rng(7)
    q, rows = np.floor(r.normal(size=(9, 5)) * 300), np.floor(r.normal(size=(40, 5)) * 300).astype("<i4")
    for share in (0.0, 0.02, 0.9, 1.0):
        overlap = r.random((9, 40)) < share
        a, b, s = H.scores_of(overlap, q, rows)
        assert (np.stack([a, b]) == np.stack(np.nonzero(overlap))).all() and (s == (q @ rows.T)[a, b]).all()
