"""SimHash near-duplicates: exact comparison in tiles (exclusive-or, bit counts).

1. Fingerprints are computed in Arrow batches and stored once (id, fingerprint).
2. Equal fingerprints collapse to one row before anything is compared, so exact
   copies never form pairs.
3. Two fingerprints within ``max_bits`` agree on at least ``blocks - max_bits``
   of ``blocks`` bit blocks, so comparing rows that share such a combination of
   blocks loses no link.  The number of blocks follows the number of distinct
   fingerprints, which keeps the expected group small at any size.
4. A group of more than ``tile_rows`` fingerprints is cut into tiles of one
   population count each; every pair of tiles whose counts differ by at most
   ``max_bits`` is its own shuffle group (other pairs cannot hold a link), so
   no task gets more than two tiles.  Inside a task, runs sorted by population
   count are compared block by block with numpy and the same skip.
5. A group emits a spanning star per connected part, never its pairs.
   Components over the stars come from alternating large-star / small-star
   rounds, each cut by a reliable checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.batches import append_columns, col, map_batches, save_and_reread

HASH_SEED = 42


# --- fingerprints ---------------------------------------------------------------------------

def fingerprints_of(texts: list[bytes | None], shingle: int, rows: int = 1 << 18) -> np.ndarray:
    """Unsigned 64-bit fingerprints; bit sums run over ``rows`` hashes at a time, whole texts always count."""
    n = np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    owner_at = [0]
    for k, text in enumerate(texts):
        words = text.lower().split() if text else []
        if 0 < len(words) <= shingle:
            hashes.append(xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED))
        elif words:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            cut = map(line.__getitem__, map(slice, starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()))
            hashes.extend(map(xxhash.xxh64_intdigest, cut, repeat(HASH_SEED)))
        owner_at.append(len(hashes))
        n[k] = owner_at[-1] - owner_at[-2]
    h = np.array(hashes, np.uint64)
    owner = np.repeat(np.arange(len(texts)), n)
    sums = np.zeros((len(texts), 64), np.int64)
    for a in range(0, len(h), rows):
        bits = np.unpackbits(h[a:a + rows].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        who = owner[a:a + rows]
        first = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
        sums[who[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    on = sums * 2 > n[:, None]
    return np.packbits(on, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def simhash(df: DataFrame, text_col: str = "text", shingle_words: int = 3, keep: list[str] | None = None) -> DataFrame:
    """Append ``fingerprint`` (bigint holding the 64 bits) to each row; null or empty text gives 0."""
    def make():
        return lambda texts: [fingerprints_of(texts, shingle_words).view(np.int64)]
    return append_columns(df, text_col, make, [("fingerprint", "bigint")], keep=keep)


# --- candidate groups -----------------------------------------------------------------------

def block_count(distinct: int, max_bits: int, group_rows: int = 64) -> int:
    """Fewest blocks whose shared combinations are expected to hold at most ``group_rows`` fingerprints."""
    for blocks in range(max_bits + 1, max_bits + 6):
        if distinct / 2 ** (64 * (blocks - max_bits) // blocks) <= group_rows:
            return blocks
    return max_bits + 6


def masks(blocks: int, max_bits: int) -> list[int]:
    """Signed 64-bit masks, one for each combination of ``blocks - max_bits`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    out = [sum(single[i] for i in pick) for pick in combinations(range(blocks), blocks - max_bits)]
    assert len(out) == comb(blocks, max_bits)
    return [m - (1 << 64) if m >> 63 else m for m in out]


def tile_rows_of(distinct: DataFrame, fp: str, max_bits: int, blocks: int, tile_rows: int) -> DataFrame:
    """One row per fingerprint and tile pair: (mask, value, pa, sa, pb, sb, side, pop, fp)."""
    keyed = (distinct.select(F.col(fp).alias("fp"), F.bit_count(fp).alias("pop"))
             .select("fp", "pop", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks(blocks, max_bits)]))
                     .alias("mask", "value")))
    per_pop = keyed.groupBy("mask", "value", "pop").agg(F.count("*").alias("n"))
    hot = (per_pop.groupBy("mask", "value")
           .agg(F.sum("n").alias("rows"), F.map_from_entries(F.collect_list(F.struct(
               "pop", F.ceil(F.col("n") / tile_rows).cast("int").alias("subs")))).alias("subs"))  # 65 entries at most
           .filter(F.col("rows") > tile_rows).drop("rows"))
    own = keyed.join(hot, ["mask", "value"], "left").withColumn(
        "s", F.when(F.col("subs").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("subs")[F.col("pop")]).cast("int")))
    near = F.filter(F.map_entries("subs"), lambda e: F.abs(e["key"] - F.col("pop")) <= max_bits)
    pairs = F.flatten(F.transform(near, lambda e: F.transform(
        F.sequence(F.lit(0), e["value"] - 1),
        lambda t: F.when((e["key"] > F.col("pop")) | ((e["key"] == F.col("pop")) & (t >= F.col("s"))),
                         F.struct(F.col("pop").alias("pa"), F.col("s").alias("sa"), e["key"].alias("pb"), t.alias("sb"),
                                  F.lit(0).alias("side")))
        .otherwise(F.struct(e["key"].alias("pa"), t.alias("sa"), F.col("pop").alias("pb"), F.col("s").alias("sb"),
                            F.lit(1).alias("side"))))))
    alone = F.array(F.struct(*[F.lit(-1).alias(c) for c in ("pa", "sa", "pb", "sb")], F.lit(0).alias("side")))
    return (own.select("mask", "value", "pop", "fp", F.explode(F.when(F.col("subs").isNull(), alone).otherwise(pairs)).alias("t"))
            .select("mask", "value", "t.*", "pop", "fp"))


# --- tiles ----------------------------------------------------------------------------------

def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the parts that the pairs (a, b) join their least label; label[i] <= i is a root or leads to one."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def link_runs(run: np.ndarray, side: np.ndarray, pop: np.ndarray, fp: np.ndarray, max_bits: int,
              tile: int = 256, short: int = 32) -> np.ndarray:
    """Labels (index of the least linked row) after comparing the rows of each run.

    Rows come sorted by run and, within it, by side and population count; a
    run with both sides compares only rows of different sides.
    """
    n = len(fp)
    label = np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    size = np.diff(np.append(first, n))
    two = np.zeros(len(first), bool)
    np.logical_or.at(two, np.repeat(np.arange(len(first)), size), side > 0)
    small = np.repeat((size <= short) & ~two, size)
    for d in range(1, short):  # short runs of this batch at once, by distance within the run
        i = np.flatnonzero(small[:-d] & (run[:-d] == run[d:])) if d < n else np.empty(0, int)
        if not len(i):
            break
        i = i[pop[i + d] - pop[i] <= max_bits]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits]
        merge_labels(label, i, i + d)
    for a, m, cross in zip(first, size, two):
        if m <= short and not cross or m < 2:
            continue
        mid = a + int(np.searchsorted(side[a:a + m], 1)) if cross else a
        lefts, right_from = (range(a, mid, tile), mid) if cross else (range(a, a + m, tile), None)
        for x in lefts:
            xe = min(x + tile, mid if cross else a + m)
            for y in range(right_from if cross else x, a + m, tile):
                ye = min(y + tile, a + m)
                if pop[y] - pop[xe - 1] > max_bits:  # sorted: all later tiles are further away
                    break
                if pop[x] - pop[ye - 1] > max_bits:
                    continue
                close = np.bitwise_count(fp[x:xe, None] ^ fp[None, y:ye]) <= max_bits
                close &= label[x:xe, None] != label[None, y:ye]  # links within a part that is known add nothing
                p, q = np.nonzero(close)
                merge_labels(label, x + p, y + q)
    return label


def link_tiles(tiles: DataFrame, max_bits: int) -> DataFrame:
    """Stars (a, b) of linked fingerprints, a row for each linked fingerprint and group at most."""
    keys = ["mask", "value", "pa", "sa", "pb", "sb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(part: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
            ids = np.cumsum(bounds)
            fp = part[8].view(np.uint64)
            label = link_runs(ids, part[6], part[7], fp, max_bits)
            i = np.flatnonzero(label != np.arange(len(label)))
            return pa.RecordBatch.from_arrays([pa.array(part[8][i]), pa.array(part[8][label[i]])], names=["a", "b"])

        rest: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            part = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            change = np.ones(len(part[0]), bool)
            change[1:] = False
            for c in part[:6]:
                change[1:] |= c[1:] != c[:-1]
            last = int(np.flatnonzero(change)[-1])  # the last run may go on in the next batch
            if last:
                yield linked([c[:last] for c in part], change[:last])
            rest = [c[last:] for c in part]
        if rest is not None:
            bounds = np.zeros(len(rest[0]), bool)
            yield linked(rest, bounds)

    dealt = tiles.repartition(*keys).sortWithinPartitions(*keys, "side", "pop")
    return map_batches(dealt.select(*keys, "side", "pop", "fp"), run, "a bigint, b bigint")


# --- components -----------------------------------------------------------------------------

def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of the undirected edges (a, b); root: the least node of its component.

    Large-star and small-star in turn until the edges no longer change.  Each
    round's minima are partial aggregates; a hub's rows are split by the skew
    join.  Every round ends in a reliable checkpoint.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def stars(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").distinct()

    cur = stars(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).checkpoint()
    before = state(cur)
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = stars(both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = stars(small.union(low.select("a", F.col("m").alias("b")))).checkpoint()
        now = state(cur)
        if now == before:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                       max_bits: int = 2, tile_rows: int = 4096) -> DataFrame:
    """(id, fingerprint bigint, component_id) for every row.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is
    the least id reachable over links, the row's own included.  Null or empty
    texts (no word) have fingerprint 0 and link like any other.  A null id is
    never a component id unless all ids of the component are null (then null).
    Repeated rows give a row each; an empty table gives no rows; other columns
    are not read.
    """
    prints = save_and_reread(simhash(df.select(col(id_col), col(text_col)), text_col, shingle_words, keep=[id_col])
                             .select(col(id_col).alias("id"), "fingerprint"), "simhash")
    per_print = print_components(prints, max_bits, tile_rows)
    return (prints.join(per_print, F.col("fingerprint") == F.col("fp"), "left")
            .select(F.col("id").alias(id_col), "fingerprint", "component_id"))


def print_components(prints: DataFrame, max_bits: int, tile_rows: int = 4096) -> DataFrame:
    """(fp, component_id) for each fingerprint of the rows (id, fingerprint): the least ``id`` of its component; nulls come last."""
    distinct = save_and_reread(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "simhash-distinct")
    blocks = block_count(distinct.count(), max_bits)
    tiles = tile_rows_of(distinct, "fingerprint", max_bits, blocks, tile_rows)
    parts = connected_components(link_tiles(tiles, max_bits))
    rooted = (distinct.join(parts, distinct["fingerprint"] == parts["node"], "left")
              .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))
    lows = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(lows, "root").select(F.col("fingerprint").alias("fp"), "component_id")


def fingerprint_hex(fingerprint: str = "fingerprint") -> F.Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                         max_bits: int = 2) -> DataFrame:
    """One row of each component, with all its columns: that of the least id (nulls last), then of the least text hash.

    Rows are told apart by a number of their own, written with them, so rows that share an
    id or have none are judged each by its text.  Of rows equal in id and text one stays.  Null
    and empty texts are one component.  An empty table stays empty; any column names are kept.
    """
    names = {n.lower() for n in df.columns}
    row = next(n for k in range(len(names) + 1) if (n := f"__row{k}") not in names)
    rows = save_and_reread(df.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    shown = rows.select(col(row).alias("row"), col(id_col).alias("given"), col(text_col).cast("string").alias("text"))
    # the least struct of a component is its representative; a null id must come last, so a flag stands before it
    key = F.struct(F.col("given").isNull().alias("none"), "given", F.xxhash64("text").alias("hash"), "row")
    prints = save_and_reread(simhash(shown.select(key.alias("id"), "text"), "text", shingle_words, keep=["id"]).select("id", "fingerprint"),
                             "simhash")
    # a shuffle join at every size: how many documents stay is not bounded, so neither is a broadcast of their numbers
    first = print_components(prints, max_bits).select(F.col("component_id.row").alias("__first")).distinct().hint("merge")
    return rows.join(first, col(row) == F.col("__first"), "left_semi").drop(row)
