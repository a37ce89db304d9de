"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded slice of whole documents of one task.  Its index is built
over the stretches of consecutive words that all occur in some phrase (a word
outside the phrases' vocabulary cannot lie in an occurrence, so it only breaks
the text, as a document's end does; stretches shorter than the shortest phrase
are passed over for the same reason).  All phrases are searched backward at
once through the ranks of a wavelet matrix over the Burrows-Wheeler transform;
occurrences are located by walking to sampled suffix positions, and their
spans are merged per document.

Documents are never shuffled.  The phrases go to the tasks as broadcasts of at
most ``block_bytes`` of item text each; a larger phrase table is searched block
by block and the spans of a document are merged by its key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.batches import WORD_TABLE, alnum_words, append_columns, col, save_and_reread

WINDOW = 10
#: Memory of one window of phrases in Python, about; and of one block of them.
WINDOW_BYTES, BLOCK_BYTES = 600, 64 << 20
SAMPLE = 8


# --- index ----------------------------------------------------------------------------------

def suffix_order(text: np.ndarray, breaks: int) -> np.ndarray:
    """Suffix array of ``text``, whose symbols below ``breaks`` are unique breaks; prefix doubling."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, h = rank.astype(np.int64), 1
    while True:
        key = rank * (n + 1)
        key[:n - h] += rank[h:] + 1
        order = np.argsort(key, kind="stable")
        step = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1:
            return order
        h *= 2


class WaveletMatrix:
    """Rank and access over symbols 0 .. sigma-1, all queries vectorised."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels, cur = [], symbols
        self.bits = max(1, int(sigma - 1).bit_length())
        for b in range(self.bits - 1, -1, -1):
            one = (cur >> b & 1).astype(bool)
            ones = np.concatenate(([0], np.cumsum(one)))
            self.levels.append((b, ones, len(cur) - int(ones[-1])))
            cur = np.concatenate((cur[~one], cur[one]))

    def rank(self, symbol: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``lo``."""
        first, pos = np.zeros_like(lo), lo
        for b, ones, zeros in self.levels:
            one = (symbol >> b & 1).astype(bool)
            first = np.where(one, zeros + ones[first], first - ones[first])
            pos = np.where(one, zeros + ones[pos], pos - ones[pos])
        return pos - first

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its rank there."""
        symbol, pos, first = np.zeros_like(at), at, np.zeros_like(at)
        for b, ones, zeros in self.levels:
            one = ones[pos + 1] > ones[pos]
            symbol |= one.astype(np.int64) << b
            first = np.where(one, zeros + ones[first], first - ones[first])
            pos = np.where(one, zeros + ones[pos], pos - ones[pos])
        return symbol, pos - first


class FMIndex:
    """Over stretches of symbols 1 .. sigma-1, given as one array with 0 after each stretch."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE):
        n, ends = len(text), text == 0
        m = int(ends.sum())
        unique = np.where(ends, np.cumsum(ends) - 1, text + m)  # each break is a symbol of its own to the sort
        order = suffix_order(unique, m)
        before = text[order - 1]  # order - 1 = -1 reads the last symbol, a break
        self.tree = WaveletMatrix(before, sigma)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.n = n
        begins = np.flatnonzero(np.concatenate(([True], ends[:-1])))
        since = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
        held = since % sample == 0  # every stretch starts with a sample, so no walk meets a break
        self.row_of = np.cumsum(held[order]) - 1
        self.sampled, self.places = held[order], order[held[order]]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of left-padded phrases (rows), read backward."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1]):
            live = live[(lengths[live] > k) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = phrases[live, phrases.shape[1] - 1 - k]
            lo[live] = self.less[c] + self.tree.rank(c, lo[live])
            hi[live] = self.less[c] + self.tree.rank(c, hi[live])
        return lo, hi

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place) of every row of the ranges."""
        count = hi - lo
        phrase = np.repeat(np.arange(len(lo)), count)
        row = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + lo[phrase]
        place, walked, live = np.full(len(row), -1, np.int64), 0, np.arange(len(row))
        while len(live):
            done = self.sampled[row[live]]
            place[live[done]] = self.places[self.row_of[row[live[done]]]] + walked
            live = live[~done]
            c, rank = self.tree.access(row[live])
            row[live] = self.less[c] + rank
            walked += 1
        return phrase, place


# --- phrases --------------------------------------------------------------------------------

class Phrases:
    """Distinct windows of the items' words, as symbols 1 .. of the vocabulary."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            w = [self.vocab.setdefault(x, len(self.vocab) + 1) for x in alnum_words(text)]
            for k in range(max(1, len(w) - window + 1) if w else 0):
                windows.setdefault(tuple(w[k:k + window]), set()).add(item)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.symbols = np.zeros((len(windows), window), np.int64)
        for i, w in enumerate(windows):
            self.symbols[i, window - len(w):] = w
        self.items = [sorted(x) for x in windows.values()]
        self.shortest = int(self.lengths.min()) if len(windows) else 0

    def find(self, docs: list[list[bytes]]) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        """(document, merged word spans [from, to), items) of the documents with an occurrence."""
        if not self.shortest:
            return
        size = np.array([len(w) for w in docs], np.int64)
        get = self.vocab.get
        symbol = np.fromiter((get(x, 0) for w in docs for x in w), np.int64, int(size.sum()))
        n = len(symbol)
        if not n:
            return
        owner = np.repeat(np.arange(len(docs)), size)
        inside = symbol > 0
        opens = inside & np.concatenate(([True], ~inside[:-1] | (owner[1:] != owner[:-1])))
        stretch = np.cumsum(opens) * inside
        long_enough = np.bincount(stretch) >= self.shortest
        long_enough[0] = False
        at = np.flatnonzero(long_enough[stretch])  # word places that the index covers
        if not len(at):
            return
        last = np.concatenate((stretch[at][1:] != stretch[at][:-1], [True]))
        spot = np.arange(len(at)) + np.cumsum(last) - last  # a break follows the last word of each stretch
        text = np.zeros(len(at) + int(last.sum()), np.int64)
        text[spot] = symbol[at]
        place_of = np.zeros(len(text), np.int64)
        place_of[spot] = at
        index = FMIndex(text, len(self.vocab) + 1)
        phrase, place = index.locate(*index.search(self.symbols, self.lengths))
        if not len(phrase):
            return
        start = place_of[place]
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + self.lengths[phrase], -1)
        hit = np.cumsum(edge[:-1]) > 0
        first_word = np.cumsum(size) - size
        border = np.concatenate(([True], owner[1:] != owner[:-1]))
        begin = hit & (border | ~np.concatenate(([False], hit[:-1])))
        end = hit & np.concatenate((border[1:] | ~hit[1:], [True]))
        spans: dict[int, list[tuple[int, int]]] = {}
        for a, b in zip(np.flatnonzero(begin).tolist(), np.flatnonzero(end).tolist()):
            d = int(owner[a])
            spans.setdefault(d, []).append((a - int(first_word[d]), b + 1 - int(first_word[d])))
        found: dict[int, set[str]] = {}
        for d, p in np.unique(np.stack((owner[start], phrase)), axis=1).T.tolist():
            found.setdefault(d, set()).update(self.items[p])
        for d, s in spans.items():
            yield d, s, sorted(found[d])


def phrase_parts(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> list[DataFrame]:
    """The items (item, t) in parts whose windows are expected to take ``block_bytes`` at most.

    A window repeats up to ``window`` words, so it is the windows that are counted, not the texts; copies of an item go
    to one part and count once there.
    """
    items = benchmark.select(col(item_col).cast("string").alias("item"), col(text_col).cast("string").alias("t")) \
        .filter("item is not null and t is not null").distinct()
    words = F.size(F.split("t", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    total = items.agg(F.sum(words.cast("bigint") * WINDOW_BYTES + F.octet_length("item"))).first()[0] or 0
    parts = -(-total // block_bytes) or 1
    return [items.filter(F.pmod(F.xxhash64("item", "t"), F.lit(parts)) == b) for b in range(parts)]


def phrase_block(part: DataFrame, window: int) -> Broadcast:
    """The windows of one part, at every task."""
    got = [(r[0], bytes(r[1])) for r in part.select("item", F.encode("t", "utf-8")).toLocalIterator()]
    return part.sparkSession.sparkContext.broadcast(Phrases(got, window))


# --- operator -------------------------------------------------------------------------------

def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


FIELDS = [("n_words", "bigint"), ("span_starts", "array<int>"), ("span_ends", "array<int>"), ("items", "array<string>")]


def scan_block(df: DataFrame, text_col: str, phrases, keep: list[str] | None) -> DataFrame:
    """Append the document's words, merged spans and items (sorted as strings) for one phrase block."""
    def make():
        def work(texts: list[bytes | None]) -> list:
            docs = [alnum_words(t) for t in texts]
            starts, ends, items = [[] for _ in docs], [[] for _ in docs], [[] for _ in docs]
            for d, spans, found in phrases.value.find(docs):
                starts[d], ends[d], items[d] = [a for a, _ in spans], [b for _, b in spans], found
            return [[len(w) for w in docs], starts, ends, items]
        return work
    return append_columns(df, text_col, make, FIELDS, keep=keep, max_bytes=8 << 20)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Append n_words, n_hit, n_items, items (an array sorted as strings), items_sha256, span_starts, span_ends, contaminated to each document.

    A phrase is ``window`` consecutive words of an item (a shorter item that
    has words is one phrase).  Words in any occurrence are hit; spans are the
    merged runs of hit words, [from, to) in words.  Null or empty texts have no
    words; items with a null id or null text are passed over; repeated items
    with one id count once; repeated documents give a row each; an empty
    benchmark marks nothing.  Input columns named like a result give way.
    """
    parts = phrase_parts(benchmark, item_col, item_text_col, window, block_bytes)
    if len(parts) == 1:
        out = scan_block(docs, text_col, phrase_block(parts[0], window), keep)
    else:
        out = merge_blocks(docs, text_col, parts, window, keep)
    hit = F.aggregate(F.zip_with("span_starts", "span_ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda x, y: x + y)
    return out.withColumns({
        "n_hit": hit,
        "n_items": F.size("items").cast("bigint"), "items_sha256": F.sha2(F.array_join("items", ","), 256), "contaminated": F.size("span_starts") > 0})


def merge_blocks(docs: DataFrame, text_col: str, blocks: list[DataFrame], window: int, keep: list[str] | None) -> DataFrame:
    """Several phrase blocks, one after the other: the spans of each text are united (keyed by the text's hash and length).

    A block leaves the driver and the executors before the next one is made.
    """
    key = [F.xxhash64(col(text_col)).alias("__h"), F.length(col(text_col)).cast("bigint").alias("__n")]
    base = docs.select("*", *key)
    parts = None
    for b in blocks:
        phrases = phrase_block(b, window)
        found = scan_block(base, text_col, phrases, ["__h", "__n"]).filter(F.size("span_starts") > 0)
        one = save_and_reread(found, "decontaminate-block").dropDuplicates(["__h", "__n", "items"])
        phrases.destroy()
        parts = one if parts is None else parts.union(one)

    def union(key: tuple, rows: pa.Table) -> pa.Table:
        spans = sorted((a, b) for s, e in zip(rows["span_starts"].to_pylist(), rows["span_ends"].to_pylist()) for a, b in zip(s, e))
        merged: list[list[int]] = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        items = sorted({x for s in rows["items"].to_pylist() for x in s})
        return pa.table({"__hh": [key[0].as_py()], "__nn": [key[1].as_py()],
                         "__s": pa.array([[a for a, _ in merged]], pa.list_(pa.int32())),
                         "__e": pa.array([[b for _, b in merged]], pa.list_(pa.int32())), "__i": pa.array([items], pa.list_(pa.string()))})

    # a text meets each block once at most, so a group holds at most one row per block
    united = parts.groupBy("__h", "__n").applyInArrow(
        union, "__hh bigint, __nn bigint, __s array<int>, __e array<int>, __i array<string>")
    names = [n for n in (docs.columns if keep is None else keep) if n.lower() not in {x for x, _ in FIELDS}]

    def make():
        return lambda texts: [[len(alnum_words(t)) for t in texts]]
    counted = append_columns(base, text_col, make, [("n_words", "bigint")], keep=names + ["__h", "__n"])
    return (counted.join(united, (F.col("__h") == F.col("__hh")) & (F.col("__n") == F.col("__nn")), "left")
            .select(*[col(n) for n in names], "n_words", F.coalesce("__s", F.array().cast("array<int>")).alias("span_starts"),
                    F.coalesce("__e", F.array().cast("array<int>")).alias("span_ends"), F.coalesce("__i", F.array().cast("array<string>")).alias("items")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents (all columns) without any benchmark window.

    Null and empty texts stay; repeated rows are judged each; any column names are kept; an empty table stays empty.
    """
    marked = [n for n in docs.columns if n.lower() in {x for x, _ in FIELDS} | {"n_hit", "n_items", "items_sha256", "contaminated"}]
    if marked:  # keep the caller's columns of these names apart from ours
        docs = docs.withColumnsRenamed({n: f"__own_{n}" for n in marked})
    out = contamination(docs, benchmark, id_col, text_col).filter("not contaminated").select(*[col(n) for n in docs.columns])
    return out.withColumnsRenamed({f"__own_{n}": n for n in marked})


WORD = re.compile(rb"[^ ]+")


def cut_spans(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    """The text without the words [start, end) of each span and what stands between them."""
    places = [m.span() for m in WORD.finditer(text.translate(WORD_TABLE))]
    out, at = [], 0
    for a, b in zip(starts, ends):
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def remove_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All documents and columns, with every benchmark passage (merged span) cut out of the text; null stays null.

    With several phrase blocks the text is cut block by block.  Empty texts stay empty, repeated rows are cut each, items with a
    null id or text are passed over, and an empty table stays empty.
    """
    out = docs
    for part in phrase_parts(benchmark, item_col, item_text_col, window, block_bytes):
        phrases = phrase_block(part, window)

        def make(phrases=phrases):
            def work(texts: list[bytes | None]) -> list:
                new = list(texts)
                for d, spans, _ in phrases.value.find([alnum_words(t) for t in texts]):
                    new[d] = cut_spans(texts[d], [a for a, _ in spans], [b for _, b in spans])
                return [[None if t is None else t.decode("utf-8", "replace") for t in new]]
            return work
        names = out.columns
        out = append_columns(out, text_col, make, [("__cut", "string")], max_bytes=8 << 20)
        out = out.select(*[col("__cut" if n == text_col else n).alias(n) for n in names])
    return out
