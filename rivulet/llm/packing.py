"""Best-fit packing of token pieces into sequences by bin completion.

The packing problem depends only on how many pieces there are of each length,
so a histogram of at most ``capacity`` counts reaches the driver, whatever the
input's size.  The plan is a list of fillings (lengths in one sequence) with
multiplicities.  Pieces are numbered within their length on the executors
(salted groups, prefix sums over the small group counts) and each finds its
sequence and offset from its number by binary search in the broadcast plan,
whose size is bounded by the number of lengths.
"""

from __future__ import annotations

import logging
import sys
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.batches import col, map_batches, save_and_reread, slices

CAPACITY = 1024
#: Copies of a row that one task writes out.
COPIES = 10_000
END_ID = 2

log = logging.getLogger("rivulet")


# --- tokens ---------------------------------------------------------------------------------

@cache
def encoder(vocabulary: str):
    """text -> ids of the byte-level BPE ``vocabulary`` (.json of the tokenizers library).

    The same merges run in tiktoken (about three times faster) when its rank
    file lies beside the .json; a text that holds a special token's string goes
    to the tokenizers library itself.  Tests hold both against each other.
    """
    import base64
    import os

    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(vocabulary)
    special = [t.content for t in whole.get_added_tokens_decoder().values() if t.special]
    ranks_file = os.path.splitext(vocabulary)[0] + ".tiktoken"
    if not os.path.exists(ranks_file):
        return lambda text: whole.encode(text, add_special_tokens=False).ids
    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    quick = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return whole.encode(text, add_special_tokens=False).ids
        return quick.encode_ordinary(text)
    return encode


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(``id``, piece, start, length, ids_crc32): each document's ids and ``end_id``, longer ones cut from the end.

    All pieces but the first of a cut document have ``capacity`` ids.  The
    vocabulary is looked up where the task runs unless a path is given.
    """
    source = df.select(col(text_col).cast("string").alias("text"), col(id_col).alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary or default_vocabulary())
        for batch in batches:
            for part in slices(batch, 0, 8 << 20):
                row, piece, start, length, crc = [], [], [], [], []
                for i, text in enumerate(part.column(0)):
                    ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                    cuts = [0, *range(len(ids) % capacity or min(len(ids), capacity), len(ids), capacity), len(ids)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["id", "piece", "start", "length", "ids_crc32"])

    kind = source.schema[1].dataType.simpleString()
    return map_batches(source, run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


# --- plan -----------------------------------------------------------------------------------

Filling = tuple[int, ...]
Plan = list[tuple[Filling, int]]


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Longest first, each into the fullest sequence that still takes it; equal sequences move together."""
    room: dict[int, list[tuple[Filling, int]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = next((s for s in range(length, capacity + 1) if room.get(s)), None)
            if space is None:  # new sequences, each filled with this length as often as it fits
                per = min(capacity // length, left)
                take = left // per
                room.setdefault(capacity - per * length, []).append(((length,) * per, take))
                left -= per * take
                continue
            filling, n = room[space].pop()
            take = min(n, left)
            if n > take:
                room[space].append((filling, n - take))
            room.setdefault(space - length, []).append((filling + (length,), take))
            left -= take
    return [x for group in room.values() for x in group]


def fillings(counts: dict[int, int], lengths: list[int], space: int, spend: Callable[[int], None] = lambda n: None) -> Iterator[Filling]:
    """All undominated fillings of ``space``, lazily, least waste first, then longest pieces first.

    A filling is dominated when a spare length still fits, or when one spare
    length could take the place of one or two of its pieces without exceeding
    the space (the longer piece leaves the easier rest).  ``lengths`` fall;
    reach[k] has a bit for each sum that lengths[k:] can make, so no branch
    ends without a filling, and one of least waste comes first (none dominates
    it).  ``spend`` is told the steps taken, those of the tests for dominance included, and may raise to end the search.
    """
    lengths = [x for x in lengths if x <= space and counts.get(x, 0) > 0]
    mask, reach = (1 << space + 1) - 1, [1] * (len(lengths) + 1)
    for k in range(len(lengths) - 1, -1, -1):
        x, sums = lengths[k], reach[k + 1]
        copies, step = min(counts[x], space // x), 1
        while copies:
            step = min(step, copies)
            sums |= sums << step * x & mask
            copies -= step
            step *= 2
        reach[k] = sums

    def dominated(fill: Filling, waste: int) -> bool:
        if not waste:
            return False
        spare = [x for x in lengths if counts[x] > fill.count(x)]
        if spare and spare[-1] <= waste:
            return True
        parts = set(fill) | {a + b for i, a in enumerate(fill) for b in fill[i + 1:]}
        spend(len(parts))
        rising = spare[::-1]
        for p in parts:
            k = bisect_right(rising, p)
            if k < len(rising) and rising[k] <= p + waste:
                return True
        return False

    def grow(at: int, left: int, fill: Filling) -> Iterator[Filling]:
        spend(1)
        if not left:
            yield fill
            return
        k = at
        while reach[k] >> left & 1 and k < len(lengths):
            x = lengths[k]
            for n in range(min(counts[x], left // x), 0, -1):
                if reach[k + 1] >> left - n * x & 1:
                    yield from grow(k + 1, left - n * x, fill + (x,) * n)
            k += 1

    for waste in range(space + 1):
        if reach[0] >> space - waste & 1:
            for fill in grow(0, space - waste, ()):
                if not dominated(fill, waste):
                    yield fill


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: pieces above capacity - k alone, the rest by volume, best k."""
    best = -(-sum(x * n for x, n in counts.items()) // capacity)
    lengths = sorted(counts)
    for k in [x for x in lengths if 2 * x <= capacity] + [0]:
        alone = sum(n for x, n in counts.items() if x > capacity - k)
        mid = [(x, n) for x, n in counts.items() if capacity - k >= x > capacity // 2]
        small = sum(x * n for x, n in counts.items() if capacity // 2 >= x >= k)
        room = sum((capacity - x) * n for x, n in mid)
        best = max(best, alone + sum(n for _, n in mid) + max(0, -(-(small - room) // capacity)))
    return best


class Spent(Exception):
    """The budget of a search is used up."""


def bin_completion(counts: dict[int, int], capacity: int, width: int | None = None, nodes: int = 6000,
                   steps: int = 4000) -> tuple[Plan, int]:
    """Least sequences found for the histogram, and the lower bound.

    Branch and bound around the longest piece left: its undominated fillings
    (the first ``width`` only, if given), used as often as the counts allow or
    once, are the branches; a branch is cut when its waste exceeds what the
    incumbent allows.  The incumbent starts as best-fit decreasing.  Search
    ends at the bound, or exhausted (the plan is then least, unless ``width``
    is given), or after ``nodes`` nodes and one for each length (a descent takes
    a length at least from node to node), or after ``steps`` steps of filling
    for each of those nodes, pooled.  A plan above the bound is then not proven.
    """
    counts = {x: n for x, n in counts.items() if n}
    bound = lower_bound(counts, capacity)
    best = best_fit_decreasing(counts, capacity)
    used = sum(n for _, n in best)
    total = sum(x * n for x, n in counts.items())
    left_nodes = nodes + len(counts)
    left_steps = left_nodes * steps
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))

    def spend(taken: int) -> None:
        nonlocal left_steps
        left_steps -= taken
        if left_steps < 0:
            raise Spent

    def search(left: dict[int, int], path: Plan, bins: int, waste: int) -> bool:
        nonlocal best, used, left_nodes
        if not left:
            if bins < used:
                best, used = list(path), bins
            return used <= bound
        left_nodes -= 1
        if left_nodes < 0:
            raise Spent
        lengths = sorted(left, reverse=True)
        top = lengths[0]
        pieces_left = sum(left.values())
        others = {x: n - (x == top) for x, n in left.items() if n > (x == top)}
        for fill in islice(fillings(others, lengths, capacity - top, spend), width):
            whole = (top, *fill)
            spare = capacity - sum(whole)
            if waste + spare > (used - 1) * capacity - total:
                break  # the fillings after this one waste as much or more
            need = {x: whole.count(x) for x in set(whole)}
            most = min(left[x] // n for x, n in need.items())
            for times in (most, 1) if most > 1 else (1,):
                if (bins + times >= used and pieces_left > len(whole) * times
                        or waste + spare * times > (used - 1) * capacity - total):
                    continue
                rest = {x: n - need.get(x, 0) * times for x, n in left.items()}
                if search({x: n for x, n in rest.items() if n}, path + [(whole, times)], bins + times, waste + spare * times):
                    return True
        return False

    if used > bound:
        try:
            search(dict(counts), [], 0, 0)
        except Spent:
            pass
    return best, bound


# --- assignment -----------------------------------------------------------------------------

def slot_tables(plan: Plan) -> dict[int, tuple[list[int], list[tuple[int, int, list[int]]]]]:
    """For each length: first number of each use, and (first sequence, pieces per sequence, their offsets)."""
    out: dict[int, tuple[list[int], list]] = {}
    reached: dict[int, int] = {}
    sequence = 0
    for filling, times in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for x in filling:
            offsets.setdefault(x, []).append(at)
            at += x
        for x, places in offsets.items():
            starts, uses = out.setdefault(x, ([], []))
            starts.append(reached.get(x, 0))
            uses.append((sequence, len(places), places))
            reached[x] = reached.get(x, 0) + len(places) * times
        sequence += times
    return out


def group_of(histogram: dict[int, int], length: Column, keys: list[Column], groups: int = 4096) -> Column:
    """Salt within a length, so that no numbering group is expected to exceed 1/``groups`` of all pieces."""
    rows = max(500, -(-sum(histogram.values()) // groups))
    salts = F.create_map(*[F.lit(v) for x, n in sorted(histogram.items()) if n > rows for v in (x, -(-n // rows))] or
                         [F.lit(0), F.lit(1)])
    return F.pmod(F.xxhash64(*keys), F.coalesce(F.try_element_at(salts, length.cast("int")), F.lit(1)).cast("bigint"))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is empty and packs as its end id alone.  Repeated rows are packed
    once each; null ids are packed like others; an empty table gives no rows;
    other columns are not read.
    """
    spark = df.sparkSession
    cut = save_and_reread(pieces(df, id_col, text_col, capacity, vocabulary, end_id), "packing-pieces")
    # one count per length (capacity rows at most), as bigint
    histogram = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return cut.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}).withColumnRenamed("id", id_col)
    plan, bound = bin_completion(histogram, capacity)
    log.info("packing: %d sequences, lower bound %d", sum(times for _, times in plan), bound)
    slots = spark.sparkContext.broadcast(slot_tables(plan))

    # equal rows are numbered as one with a count, so a hot one is no group of its own
    keys = [F.col("id"), F.col("piece"), F.col("ids_crc32"), F.col("start")]
    distinct = cut.groupBy("id", "piece", "start", "length", "ids_crc32").agg(F.count("*").alias("copies"))
    salted = distinct.withColumn("salt", group_of(histogram, F.col("length"), keys))
    sizes = salted.groupBy("length", "salt").agg(F.sum("copies").alias("n"))  # capacity + 4096 rows or so at most
    before = sizes.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("base"))
    upto = Window.partitionBy("length", "salt").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    first = (salted.withColumn("first", F.sum("copies").over(upto) - F.col("copies")).join(before, ["length", "salt"])
             .select("id", "piece", "start", "length", "ids_crc32", "copies", (F.col("base") + F.col("first")).alias("number")))
    run = F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES).cast("bigint"))
    runs = first.withColumn("skip", F.explode(run))  # a row for each so many copies
    long = (runs.filter(F.col("copies") > COPIES).repartition(F.xxhash64("number", "skip"))
            .withColumn("nth", F.explode(F.sequence(F.col("skip"), F.least(F.col("skip") + COPIES, F.col("copies")) - 1))))
    short = runs.filter(F.col("copies") <= COPIES).withColumn("nth", F.explode(F.sequence(F.col("skip"), F.col("copies") - 1)))
    numbered = short.union(long).select("id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("nth")).alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = [], []
            for length, number in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist()):
                starts, uses = slots.value[length]
                k = bisect_right(starts, number) - 1
                first, per, places = uses[k]
                nth = number - starts[k]
                sequence.append(first + nth // per)
                offset.append(places[nth % per])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                             names=[*batch.schema.names[:5], "sequence_id", "offset"])

    kind = cut.schema[0].dataType.simpleString()
    return map_batches(numbered, place, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                      "sequence_id bigint, offset bigint").withColumnRenamed("id", id_col)
