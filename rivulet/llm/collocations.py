"""Phrase collocations by dynamic itemset counting.

Documents are dealt once into shards, as chunks of numbered words, that are scanned in a cycle, one shard a
step.  Words are counted from the first step; a longer phrase becomes active in
the step after both its subphrases (all but its last word, all but its first)
have been seen ``min_count`` times so far, whatever its length and whichever
shard comes next, and is counted for one full cycle.  Every shard is thus seen once by every phrase
that can be frequent, and several lengths are counted in the same scan.

Which phrases are active must be known to every task.  Tasks get one table of
fixed size a length: a phrase has two slots, each holding the first step in
which a phrase of that slot reached the threshold, and counts as reaching it in the later of
the two (or when its subphrases did, if that was later).  Slots never change once set, so a phrase that shares both
with others starts at a fixed step too.  A second table has eight bits for each slot, two of which a phrase that reached
the threshold sets; it is full eight times later.

Most phrases never reach the threshold, so the cycle counts hashes, not texts: 48 bits of hash and 16 of count,
sorted arrays of which are the rows that tasks exchange.  Phrases of equal hash are counted as one, which can only mark more
bits.  A phrase whose bits are set needs no more counting, and one that completed its cycle below the threshold
cannot be frequent; both leave the counts so far.  After the cycle one scan counts the texts of the phrases with set
bits, all others being infrequent, so the counts returned are exact at every table size and for every hash.
"""

from __future__ import annotations

import logging
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivulet.llm.batches import col, drop_saved, map_batches, save_and_reread, slices

log = logging.getLogger(__name__)

SHARDS = 4
#: Slots of one length's table (a byte each), as a power of two.
SLOT_BITS = 24
NEVER = 255
#: Text in one dealt chunk, and in all chunks that a task has begun.
CHUNK_BYTES = 2 << 20
BEGUN_BYTES = 32 << 20
#: Words that a task counts together.
WORDS_AT_ONCE = 2 << 20
#: Hashes are dealt to so many groups, as a power of two, by their first bits.
PART_BITS = 8
#: The last bits of a counted hash are its count, which stops at their maximum.
MOST = (1 << 16) - 1
#: Lower case for A-Z; ``.`` for the ends of pieces ``[.,;:!?\x0A-\x0D]``; a space for a tab.
FOLD = bytes(0x2E if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
END = b"."

DEALT = "shard int, lang string, carry int, words binary, ids binary"
COUNTED = "part int, n int, start int, hashes binary"
EXACT = "lang string, n int, phrase string, f bigint"


class Tables:
    """One table a length for the tasks; mostly empty or mostly repeated bytes, so pickled compressed."""

    def __init__(self, of: list[np.ndarray]):
        self.of = of

    def __getstate__(self):
        return [zlib.compress(t, 1) for t in self.of]

    def __setstate__(self, state):
        self.of = [np.frombuffer(zlib.decompress(t), np.uint8) for t in state]

    def reached(self, n: int, hashes: np.ndarray) -> np.ndarray:
        """The step in which each phrase of n words counts as having reached the threshold (``NEVER`` if not yet)."""
        table = self.of[n - 1]
        a, b = bits_of(hashes, len(table))
        return np.maximum(table[a >> 3], table[b >> 3]).astype(np.int16)


class Marks(Tables):
    """Which phrases reached the threshold, in any step: a table has eight bits in the place of each slot's step."""

    def reached(self, n: int, hashes: np.ndarray) -> np.ndarray:
        table = self.of[n - 1]
        a, b = bits_of(hashes, len(table))
        return np.where((table[a >> 3] >> (a & 7)) & (table[b >> 3] >> (b & 7)) & 1, 0, NEVER).astype(np.int16)


def chunks(text: bytes, carry: int, size: int = CHUNK_BYTES) -> Iterator[tuple[list[bytes], int]]:
    """Words and piece ends of a text in chunks; each begins with the last ``carry`` of the former one, whose number is given."""
    folded = text.translate(FOLD).replace(END, b" . ")
    at, kept = 0, []
    while at < len(folded):
        stop = folded.find(b" ", min(at + size, len(folded)))
        stop = len(folded) if stop < 0 else stop
        tokens = kept + folded[at:stop].split()
        yield tokens, len(kept)
        kept, at = tokens[-carry:] if carry else [], stop


def numbering() -> dict[bytes, int]:
    """Numbers words as they are looked up; a piece's end is 0."""
    index: dict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    index[END]  # noqa: B018
    return index


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of a phrase and the word behind it."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def block_bits(slots: int) -> int:
    """The first bits of a hash that name the block of a table that both its slots are in: hashes of one part share a block."""
    return min(PART_BITS, slots.bit_length() - 1)


def bits_of(hashes: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a table of so many slots of eight, which the count in a hash does not change."""
    block = block_bits(slots)
    inside = slots.bit_length() + 2 - block
    first = (hashes >> np.uint64(64 - block)) << np.uint64(inside) if block else np.uint64(0)
    x = (hashes >> np.uint64(16)) * np.uint64(0x9E3779B97F4A7C15)
    a, b = x >> np.uint64(64 - inside), (x >> np.uint64(64 - 2 * inside)) & np.uint64((1 << inside) - 1)
    return (a | first).astype(np.int64), (b | first).astype(np.int64)


def deal(given: DataFrame, max_words: int) -> DataFrame:
    """Chunks of texts (shard, lang, text): distinct words, joined by spaces, and the number of each word of the text in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun: dict[tuple[int, str], list[bytes]] = defaultdict(list)
        sizes: dict[tuple[int, str], int] = defaultdict(int)

        def written(key: tuple[int, str]) -> Iterator[pa.RecordBatch]:
            del sizes[key]
            for tokens, carry in chunks(END.join(begun.pop(key)), max_words - 1):
                index = numbering()
                ids = np.fromiter(map(index.__getitem__, tokens), np.int32, len(tokens))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.string()), pa.array([carry], pa.int32()),
                     pa.array([b" ".join(index)], pa.binary()), pa.array([ids.tobytes()], pa.binary())],
                    names=["shard", "lang", "carry", "words", "ids"])

        for batch in batches:
            for piece in slices(batch, 2, CHUNK_BYTES):
                for shard, lang, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), piece.column(2).cast(pa.binary()).to_pylist()):
                    if text:
                        key = shard, lang
                        begun[key].append(text)
                        sizes[key] += len(text)
                        if sizes[key] >= CHUNK_BYTES:
                            yield from written(key)
                if sum(sizes.values()) >= BEGUN_BYTES:
                    for key in list(sizes):
                        yield from written(key)
        for key in list(sizes):
            yield from written(key)

    return map_batches(given.select("shard", "lang", "text"), run, DEALT)


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """Dealt chunks (lang, carry, words, ids), about ``WORDS_AT_ONCE`` words at a time, each language by itself.

    Gives the language, its distinct words, their numbers in the order of the text (an end between two chunks), and
    which of these places are new (not carried over).
    """

    def joined(lang: str, rows: list[tuple[int, bytes, np.ndarray]]) -> tuple[str, list[bytes], np.ndarray, np.ndarray]:
        index = numbering()
        ids, new = [], []
        for carry, words, numbers in rows:
            ids += [np.fromiter(map(index.__getitem__, words.split(b" ")), np.int32)[numbers], np.zeros(1, np.int32)]
            new.append(np.arange(len(numbers) + 1) >= carry)
        return lang, list(index), np.concatenate(ids), np.concatenate(new)

    waiting: dict[str, list[tuple[int, bytes, np.ndarray]]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, carry, words, ids in zip(*batch.columns):
            numbers = np.frombuffer(ids.as_py(), np.int32)
            waiting[lang.as_py()].append((carry.as_py(), words.as_py(), numbers))
            size += len(numbers)
            if size >= WORDS_AT_ONCE:
                for key in list(waiting):
                    yield joined(key, waiting.pop(key))
                size = 0
    for key in list(waiting):
        yield joined(key, waiting.pop(key))


def places(lang: str, words: list[bytes], ids: np.ndarray, tables: Tables) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(words in a phrase, places of first words, hashes, steps in which its subphrases had reached the threshold) of the phrases whose subphrases have."""
    of_word = word_hashes(lang, words)
    since = tables.reached(1, of_word)
    since[0] = NEVER
    hashes, since = of_word[ids], since[ids]
    at = np.flatnonzero(ids)
    yield 1, at, hashes[at], np.full(len(at), -1, np.int16)
    for k in range(2, min(len(tables.of), len(ids)) + 1):
        both = np.maximum(since[:-1], since[1:])
        at = np.flatnonzero(both < NEVER)
        found, both = mixed(hashes[at], of_word[ids[at + k - 1]]), both[at]
        yield k, at, found, both
        if k < len(tables.of):
            size = len(since) - 1
            hashes, since = np.zeros(size, np.uint64), np.full(size, NEVER, np.int16)
            hashes[at], since[at] = found, np.maximum(tables.reached(k, found), both)


def counted(shard: DataFrame, shared: Broadcast, step: int, shards: int) -> DataFrame:
    """Hashes, with their counts, of the phrases active in this step; not yet summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        edges = np.arange(1, 1 << PART_BITS, dtype=np.uint64) << np.uint64(64 - PART_BITS)
        for lang, words, ids, new in together(batches):
            for k, at, hashes, both in places(lang, words, ids, tables):
                start = both + 1
                active = new[at + k - 1] & (start <= step) & (step < start + shards)
                hashes, start = hashes[active], start[active]
                for s in np.unique(start).tolist():
                    found, times = np.unique(hashes[start == s], return_counts=True)
                    packed = (found & np.uint64(~MOST & (2 ** 64 - 1))) | np.minimum(times, MOST).astype(np.uint64)
                    dealt = [(p, e.tobytes()) for p, e in enumerate(np.split(packed, np.searchsorted(packed, edges))) if len(e)]
                    m = len(dealt)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p for p, _ in dealt], pa.int32()), pa.array(np.full(m, k, np.int32)), pa.array(np.full(m, s, np.int32)),
                         pa.array([e for _, e in dealt], pa.binary())], names=["part", "n", "start", "hashes"])

    return map_batches(shard.select("lang", "carry", "words", "ids"), run, COUNTED)


def summed(rows: DataFrame, step: int, shards: int, min_count: int, slots: int) -> DataFrame:
    """Hashes below the threshold whose cycle goes on, with their counts so far; of those that reached it (``done``) the bits of their block, compressed."""
    need, block = min(min_count, MOST), slots >> block_bits(slots)

    def run(group: pa.Table) -> pa.Table:
        given: dict[tuple[int, int], list[bytes]] = defaultdict(list)
        for n, start, hashes in zip(group.column("n").to_pylist(), group.column("start").to_pylist(), group.column("hashes").to_pylist()):
            given[n, start].append(hashes)
        out, marks = [], {}
        for n, start in list(given):
            e = np.sort(np.frombuffer(b"".join(given.pop((n, start))), np.uint64))
            first = np.flatnonzero(np.concatenate([[True], (e[1:] ^ e[:-1]) > np.uint64(MOST)]))
            total = np.add.reduceat(e & np.uint64(MOST), first)
            hashes = e[first] & np.uint64(~MOST & (2 ** 64 - 1))
            done = total >= need
            if done.any():
                flags = marks.setdefault(n, np.zeros(8 * block, bool))
                for bits in bits_of(hashes[done], slots):
                    flags[bits & (8 * block - 1)] = True
            if start + shards - 1 > step and not done.all():
                out.append((n, start, False, (hashes | total)[~done].tobytes()))
        out += [(n, step, True, zlib.compress(np.packbits(flags, bitorder="little"), 1)) for n, flags in marks.items()]
        n, start, done, hashes = zip(*out) if out else ([],) * 4
        return pa.table([pa.array([group.column("part")[0].as_py()] * len(out), pa.int32()), pa.array(n, pa.int32()), pa.array(start, pa.int32()),
                         pa.array(hashes, pa.binary()), pa.array(done, pa.bool_())], names=["part", "n", "start", "hashes", "done"])

    return rows.groupBy("part").applyInArrow(run, f"{COUNTED}, done boolean")


def mark(steps: list[np.ndarray], marks: list[np.ndarray], done: DataFrame, step: int) -> bool:
    """Set the slots and bits of the phrases that reached the threshold in this step; whether that lets longer phrases start.

    The driver gets at most eight bits for each slot of the tables, however many phrases there are.
    """
    longer = False
    for row in done.select("part", "n", "hashes").collect():
        bits = np.frombuffer(zlib.decompress(bytes(row["hashes"])), np.uint8)
        first = len(bits) * (row["part"] >> (PART_BITS - block_bits(len(marks[0]))))
        marks[row["n"] - 1][first:first + len(bits)] |= bits
        table = steps[row["n"] - 1][first:first + len(bits)]
        new = (bits != 0) & (table == NEVER)
        table[new] = step
        longer |= row["n"] < len(steps) and bool(new.any())
    return longer


def count_texts(lang: str, words: list[bytes], ids: np.ndarray, new: np.ndarray, tables: Tables) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(words in a phrase, phrases, counts) of the phrases with set bits; 0 words: the number of all words."""
    yield 0, [b""], np.array([np.count_nonzero(ids[new])])
    size = len(words)
    for k, at, hashes, _ in places(lang, words, ids, tables):
        at = at[new[at + k - 1] & (tables.reached(k, hashes) != NEVER)]
        if size ** k < 2 ** 63:
            key = ids[at].astype(np.int64)
            for j in range(1, k):
                key = key * size + ids[at + j]
            keys, counts = np.unique(key, return_counts=True)
            digits = []
            for _ in range(k):
                keys, digit = np.divmod(keys, size)
                digits.append(digit)
            parts = digits[::-1]
        else:
            parts, counts = np.unique(np.stack([ids[at + j] for j in range(k)]), axis=1, return_counts=True)
        yield k, [b" ".join(p) for p in zip(*([words[i] for i in p.tolist()] for p in parts))], counts


def texts_counted(dealt: DataFrame, shared: Broadcast) -> DataFrame:
    """Texts and counts of the phrases with set bits; not yet summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids, new in together(batches):
            for n, phrases, counts in count_texts(lang, words, ids, new, shared.value):
                m = len(phrases)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(m, np.int64))), pa.array(np.full(m, n, np.int32)),
                     pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64))], names=["lang", "n", "phrase", "f"])

    return map_batches(dealt.select("lang", "carry", "words", "ids"), run, EXACT)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, max_words: int = 3,
                     shards: int = SHARDS, slot_bits: int = SLOT_BITS) -> DataFrame:
    """Words and phrases of up to ``max_words`` words found ``min_count`` times or more, by language, with exact counts.

    Rows (lang, n words, phrase, f); n = 0 holds the number of all word occurrences of the language.
    """
    if shards * max_words >= NEVER:
        raise ValueError("shards * max_words must stay below 255")
    given = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), col(text_col).cast("string").alias("text"))
    # dealt by row, not by text, so that copies spread over the shards
    given = given.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    dealt = save_and_reread(deal(given, max_words), "phrases-shards", by=["shard"])
    context = docs.sparkSession.sparkContext
    steps, marks = ([np.full(1 << slot_bits, empty, np.uint8) for _ in range(max_words)] for empty in (NEVER, 0))
    state, last, step = None, -1, 0
    while step <= last + shards:
        shared = context.broadcast(Tables(steps))
        rows = counted(dealt.filter(F.col("shard") == step % shards), shared, step, shards)
        if state is not None:
            rows = rows.unionByName(state.filter("not done").drop("done"))
        older, state = state, save_and_reread(summed(rows, step, shards, min_count, 1 << slot_bits), "phrases-counts", by=["done"])
        shared.destroy()  # gone from all machines after the step
        if older is not None:
            drop_saved(older)
        if mark(steps, marks, state.filter("done"), step):
            last = step
        step += 1
    log.info("%d steps of %d shards", step, shards)
    shared = context.broadcast(Marks(marks))
    total = texts_counted(dealt, shared).groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
    found = save_and_reread(total.filter((F.col("f") >= min_count) | (F.col("n") == 0)), "phrases-found")
    shared.destroy()
    drop_saved(dealt)
    if state is not None:
        drop_saved(state)
    return found


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, max_words: int = 3,
                 cover_percent: int = 50, top: int = 2000, shards: int = SHARDS, slot_bits: int = SLOT_BITS) -> DataFrame:
    """The best collocations of every language.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
    those into words ``[^\\x20\\x09]+``.  A phrase of 2 to ``max_words`` words found ``a >= min_count``
    times is a candidate.  Cut behind its first k words it has the score
    ``floor(1000000 a a / (l r))`` with the counts of both parts; its lowest cut
    counts, ties to the smallest k.  Products are decimals of 38 digits (counts below 10^15), so they are
    exact.  A candidate inside a longer candidate that has at least ``cover_percent`` of its count is dropped.

    A null language is ``und``; a null or empty text has no words; repeated rows count
    each; texts of any length are counted in chunks; other columns are ignored; ties of
    score and count go to the smaller phrase by bytes.  An empty table gives no rows.

    Returns lang, rank, phrase, a, l, r, n, score (rank an int, numbers long).
    """
    found = frequent_phrases(docs, text_col, lang_col, min_count, max_words, shards, slot_bits)
    f = found.filter("n > 0").select("lang", "phrase", "f")
    candidates = found.filter("n > 1").select("lang", "n", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    text = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
            .select("lang", "phrase", "a", "k", text(F.lit(1), F.col("k")).alias("left"), text(F.col("k") + 1, F.col("n") - F.col("k")).alias("right")))
    cuts = (cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    exact = {c: f"cast({c} as decimal(15,0))" for c in "alr"}
    score = F.expr(f"({exact['a']} * {exact['a']} * cast(1000000 as decimal(7,0))) div ({exact['l']} * {exact['r']})")
    scored = (cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    inner = (candidates.filter("n > 2").select("lang", "a", "n", "w", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("size"))
             .select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)).alias("at"))
             .groupBy("lang", text(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("a"))))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = (kept.withColumn("salt", salt)
             .withColumn("place", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= top))
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = found.filter("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
