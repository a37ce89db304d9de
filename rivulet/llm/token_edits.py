"""Edit-aware token counts.

A document keeps a segment tree over its pre-tokens: leaves of about ``LEAF``
pre-tokens with their characters and tokens, and subtree sums above them.  An
edit descends to the leaves it touches, re-splits the text from a leaf border
that the edit cannot have moved until the new borders meet an old leaf border
again, and updates the sums on the paths of the leaves concerned.

The split looks ahead only (a match depends on the text from its start on), so
(a) pre-tokens that start three or more characters before the edit and end
before it stay, because no alternative of the pattern looks further, and (b)
once a new border falls on an old one behind the edit, all later ones agree.
Trees are stored as two arrays per row (leaf characters, leaf tokens), so later
edits need not re-encode the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.batches import append_columns, col, map_batches, slices
from rivulet.llm.packing import default_vocabulary, encoder

LEAF = 64
CACHED_PIECES = 400_000
EDITS = "array<struct<start:bigint,deleted:bigint,inserted:string>>"


@cache
def splitter():
    import public_tokenizers
    import regex
    return regex.compile(public_tokenizers.PATTERN)


@cache
def special_tokens(vocabulary: str) -> tuple[str, ...]:
    """Strings that the tokenizer takes as one token wherever they stand, longest first."""
    from tokenizers import Tokenizer
    added = Tokenizer.from_file(vocabulary).get_added_tokens_decoder().values()
    return tuple(sorted((t.content for t in added if t.special), key=lambda t: (-len(t), t)))


class Counter:
    """Splits texts and counts the tokens of a piece, with a bounded memory of earlier answers."""

    def __init__(self, vocabulary: str | None = None):
        vocabulary = vocabulary or default_vocabulary()
        self.encode, self.known = encoder(vocabulary), {}
        special = special_tokens(vocabulary)
        self.longest = max(map(len, special), default=0)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def pieces(self, text: str) -> list[str]:
        """All pieces of the text."""
        out: list[str] = []
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            out += splitter().findall(text, at, found.start())
            out.append(found.group())
            at = found.end()
        return out + splitter().findall(text, at) if at else splitter().findall(text)

    def split(self, text: str, begin: int = 0) -> Iterator[str]:
        """Pieces of the text from ``begin`` on, which must be a border: special tokens, and pre-tokens between them."""
        at = begin
        while at < len(text):
            found = self.special.search(text, at) if self.special else None
            for m in splitter().finditer(text, at, found.start() if found else len(text)):
                yield m.group()
            if not found:
                return
            yield found.group()
            at = found.end()

    def __call__(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            n = self.known[piece] = len(self.encode(piece))
        return n


def leaves_of(pieces: list[str], count: Counter, size: int = LEAF) -> tuple[list[int], list[int]]:
    chars, tokens = list(map(len, pieces)), list(map(count, pieces))
    return ([sum(chars[k:k + size]) for k in range(0, len(pieces), size)],
            [sum(tokens[k:k + size]) for k in range(0, len(pieces), size)])


class SegmentTree:
    """Sums of characters and tokens over leaves (a complete binary tree in two arrays)."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.n = max(1, len(chars))
        self.width = 1 << (self.n - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        self.chars[self.width:self.width + len(chars)] = chars
        self.tokens[self.width:self.width + len(tokens)] = tokens
        for k in range(self.width - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place`` (the last one beyond the end), and where it starts."""
        if place >= self.chars[1]:
            return self.n - 1, self.chars[1] - self.chars[self.width + self.n - 1]
        k, start = 1, 0
        while k < self.width:
            k *= 2
            if place - start >= self.chars[k]:
                start += self.chars[k]
                k += 1
        return k - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        k = self.width + leaf
        self.chars[k], self.tokens[k] = chars, tokens
        while k > 1:
            k //= 2
            self._sum(k)

    def leaves(self) -> tuple[list[int], list[int]]:
        return self.chars[self.width:self.width + self.n], self.tokens[self.width:self.width + self.n]


class Document:
    """A text with its tree; ``reencoded`` counts the characters split again by edits."""

    def __init__(self, text: str, count: Counter, chars: list[int] | None = None, tokens: list[int] | None = None):
        self.text, self.count, self.reencoded = text, count, 0
        if chars is None or tokens is None:
            chars, tokens = leaves_of(count.pieces(text), count)
        self.tree = SegmentTree(chars, tokens)

    @property
    def n_tokens(self) -> int:
        return self.tree.tokens[1]

    def edit(self, start: int, deleted: int, inserted: str) -> None:
        """Replace ``deleted`` characters from ``start`` (both clipped to the text) by ``inserted``."""
        start = min(max(0, start), len(self.text))
        stop = min(start + max(0, deleted), len(self.text))
        if start == stop and not inserted:
            return
        shift = len(inserted) - (stop - start)
        self.text = self.text[:start] + inserted + self.text[stop:]
        first, begin = self.tree.leaf_at(max(0, start - 2 - self.count.longest))
        last, at = self.tree.leaf_at(stop)
        border = at + self.tree.chars[self.tree.width + last]  # old end of leaf `last`
        pieces, place = [], begin
        for piece in self.count.split(self.text, begin):
            # move on to the first old border that lies behind the split so far
            while last + 1 < self.tree.n and border + shift < place:
                last += 1
                border += self.tree.chars[self.tree.width + last]
            if place == border + shift and place >= start + len(inserted):
                break
            pieces.append(piece)
            place += len(piece)
        while last + 1 < self.tree.n and border + shift < place:
            last += 1
            border += self.tree.chars[self.tree.width + last]
        self.reencoded += place - begin
        slots = last - first + 1
        per = -(-len(pieces) // slots)
        if per > 4 * LEAF or self.tree.width == 1 and per > LEAF:  # a large insertion: new leaves
            chars, tokens = self.tree.leaves()
            new_chars, new_tokens = leaves_of(pieces, self.count)
            self.tree = SegmentTree(chars[:first] + new_chars + chars[last + 1:], tokens[:first] + new_tokens + tokens[last + 1:])
            return
        for k in range(slots):
            part = pieces[k * per:(k + 1) * per]
            self.tree.put(first + k, sum(map(len, part)), sum(map(self.count, part)))


# --- operators ------------------------------------------------------------------------------

def build_trees(df: DataFrame, text_col: str = "text", vocabulary: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Append leaf_chars, leaf_tokens and n_tokens to each row; null and empty texts have no leaves and no tokens."""
    def make():
        count = Counter(vocabulary)

        def work(texts: list[bytes | None]) -> list:
            found = [leaves_of(count.pieces((t or b"").decode("utf-8", "replace")), count) for t in texts]
            return [[c for c, _ in found], [t for _, t in found], [sum(t) for _, t in found]]
        return work
    return append_columns(df, text_col, make, [("leaf_chars", "array<int>"), ("leaf_tokens", "array<int>"), ("n_tokens", "bigint")], keep=keep)


def attach_edits(trees: DataFrame, edits: DataFrame, id_col: str = "doc_id", seq_col: str = "seq") -> DataFrame:
    """Add ``edits``, the document's rows (start, deleted, inserted) in order of ``seq``; documents without any get an empty list.

    Edits without a document or id are passed over; edits of equal ``seq`` apply in the order of start, deleted, inserted; repeated edits
    apply each; a repeated document gets them in each of its rows.  All columns stay (one named
    ``edits`` gives way); an empty table stays empty.
    """
    per_doc = (edits.filter(col(id_col).isNotNull()).groupBy(col(id_col).alias("__id"))
               .agg(F.array_sort(F.collect_list(F.struct(col(seq_col).alias("seq"), "start", "deleted", "inserted"))).alias("__edits")))
    plain = F.transform("__edits", lambda e: F.struct(e["start"].cast("bigint").alias("start"), e["deleted"].cast("bigint").alias("deleted"),
                                                      e["inserted"].alias("inserted")))
    names = [n for n in trees.columns if n.lower() != "edits"]
    return (trees.join(per_doc, col(id_col) == F.col("__id"), "left")
            .select(*[col(n) for n in names], F.coalesce(plain, F.array().cast(EDITS)).alias("edits")))


def apply_edits(trees: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits",
                vocabulary: str | None = None) -> DataFrame:
    """(id, text, leaf_chars, leaf_tokens, n_tokens_before, n_tokens, n_edits, reencoded_chars) after each row's edits in order.

    A null edit list is empty; null starts and lengths are 0, null insertions
    empty; ranges are clipped to the text.  Null text is empty.  Repeated rows
    are edited each; an empty table stays empty.
    """
    source = trees.select(col(text_col).cast("string").alias("text"), col(id_col).alias("id"), "leaf_chars", "leaf_tokens",
                          col(edits_col).cast(EDITS).alias("edits"))
    kind = source.schema[1].dataType.simpleString()
    names = ["id", "text", "leaf_chars", "leaf_tokens", "n_tokens_before", "n_tokens", "n_edits", "reencoded_chars"]
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(vocabulary)
        for batch in batches:
            for part in slices(batch, 0, 4 << 20):
                rows = []
                for text, _, chars, tokens, edits in zip(*[c.to_pylist() for c in part.columns]):
                    doc = Document(text or "", count, chars, tokens)
                    before = doc.n_tokens
                    for e in edits or []:
                        doc.edit((e and e["start"]) or 0, (e and e["deleted"]) or 0, (e and e["inserted"]) or "")
                    rows.append((doc.text, *doc.tree.leaves(), before, doc.n_tokens, len(edits or []), doc.reencoded))
                new = list(zip(*rows)) or [()] * 7
                types = [pa.string(), ints, ints] + [pa.int64()] * 4
                yield pa.RecordBatch.from_arrays([part.column(1)] + [pa.array(v, t) for v, t in zip(new, types)], names=names)

    return map_batches(source, run, f"id {kind}, text string, leaf_chars array<int>, leaf_tokens array<int>, "
                                  "n_tokens_before bigint, n_tokens bigint, n_edits bigint, reencoded_chars bigint").withColumnRenamed("id", id_col)
