"""Quality rules with line sequence labelling.

A linear-chain conditional random field labels each line of a document as
content or boilerplate; Viterbi decoding finds the best label sequence, and the
share of words in content lines decides retention.  Base rules on repeated word
windows and length reject before that.

The field is trained here, on a bounded sample of documents with a quality
label.  There are no line labels, so lines of good documents count as content,
and those of bad documents are relabelled by the model itself between training
rounds (hard expectation maximisation), each bad document keeping at least its
least content-like line as boilerplate.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.batches import append_columns, col

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Lines in one chain while training.
LONGEST = 256
CONTENT, BOILERPLATE = 0, 1
FEATURES = ["bias", "log_words", "distinct_words", "adjacent_repeats", "symbols", "shouted", "loud_ends", "sentence_end",
            "line_repeats", "long_words", "short_line", "no_stop_mark"]


# --- base measures --------------------------------------------------------------------------

def repeated_words(docs: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Words of each document inside windows that occur twice or more in it."""
    out = np.zeros(len(docs), np.int64)
    size = np.array([len(w) for w in docs], np.int64)
    n = int(size.sum())
    if n < window:
        return out
    ids: dict[bytes, int] = {}
    word = np.fromiter((ids.setdefault(w, len(ids)) for d in docs for w in d), np.uint64, n)
    owner = np.repeat(np.arange(len(docs)), size)
    with np.errstate(over="ignore"):
        word = mix(word + np.uint64(1))
        key = np.zeros(n - window + 1, np.uint64)
        for k in range(window):
            key = key * np.uint64(0x9E3779B97F4A7C15) + word[k:n - window + 1 + k]
        key = mix(key ^ mix(owner[:n - window + 1].astype(np.uint64) << np.uint64(20)))
    at = np.flatnonzero(owner[:n - window + 1] == owner[window - 1:])
    key = key[at]
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    spot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    at = at[twice[spot] == key]
    edge = np.zeros(n + 1, np.int64)
    edge[at] += 1
    edge[at + window] -= 1  # places are distinct, so plain indexing counts each
    return np.bincount(owner, np.cumsum(edge[:-1]) > 0, len(docs)).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed multipliers of the splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SPACE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))


def word_chars(text: bytes) -> int:
    """Code points outside the six ASCII white-space characters."""
    return len(text.translate(None, SPACE + CONTINUATION))


def n_symbols(text: bytes) -> int:
    return len(text) - len(text.translate(None, SYMBOLS))


# --- lines ----------------------------------------------------------------------------------

def line_features(text: bytes) -> tuple[list[list[float]], list[int], int]:
    """Features and word count of each line with a word, and how many such lines equal an earlier one."""
    rows, counts, repeats = [], [], 0
    seen: set[bytes] = set()
    for line in text.split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        again = line in seen
        seen.add(line)
        repeats += again
        chars = len(line)
        last = line.rstrip()[-1:]
        rows.append([
            1.0, min(np.log1p(n), 8.0) / 8, len(set(words)) / n, sum(map(bytes.__eq__, words, words[1:])) / n,
            min(1.0, 10 * n_symbols(line) / chars), sum(map(bytes.isupper, words)) / n,
            sum(w.endswith((b"!", b"?!")) for w in words) / n, float(last in b".?!\"'" and last != b""), float(again),
            float(chars / n > 12), float(n < 4), float(n > 5 and not any(w[-1:] in b".,;:!?" for w in words))])
        counts.append(n)
    return rows, counts, repeats


@dataclass
class LineField:
    """Weights of a two-label linear chain; a positive unary score speaks for boilerplate."""
    unary: np.ndarray
    start: np.ndarray
    step: np.ndarray  # step[from, to]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        s = np.zeros((len(rows), 2))
        s[:, BOILERPLATE] = rows @ self.unary
        return s


def empty_field() -> LineField:
    return LineField(np.zeros(len(FEATURES)), np.zeros(2), np.zeros((2, 2)))


def chains(sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each place in a chain: the chains that reach it (longest first) and their line's row."""
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    reach = np.searchsorted(-sizes[order], -np.arange(1, (sizes.max() if len(sizes) else 0) + 1), side="right")
    return [(order[:r], first[order[:r]] + t) for t, r in enumerate(reach)]


def viterbi(field: LineField, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Best label of each line; a tie goes to content.  All chains advance together, one place at a time."""
    label = np.zeros(len(rows), np.int8)
    if not len(rows):
        return label
    unary, back, steps = field.scores(rows), np.zeros((len(rows), 2), np.int8), chains(sizes)
    best = np.zeros((len(sizes), 2))
    for t, (who, row) in enumerate(steps):
        if t == 0:
            best[who] = field.start + unary[row]
        else:
            through = best[who][:, :, None] + field.step
            back[row] = through.argmax(axis=1)
            best[who] = through.max(axis=1) + unary[row]
    now = best.argmax(axis=1).astype(np.int8)
    for who, row in reversed(steps):
        label[row] = now[who]
        now[who] = back[row, now[who]]
    return label


def gradients(field: LineField, rows: np.ndarray, sizes: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """Weighted log-likelihood gradients by forward-backward over all chains together."""
    unary, steps = field.scores(rows), chains(sizes)
    alpha, beta = np.zeros((len(rows), 2)), np.zeros((len(rows), 2))
    for t, (who, row) in enumerate(steps):
        alpha[row] = unary[row] + (field.start if t == 0 else np.logaddexp.reduce(alpha[row - 1][:, :, None] + field.step, axis=1))
    for t in range(len(steps) - 2, -1, -1):
        row = steps[t + 1][1] - 1
        beta[row] = np.logaddexp.reduce(field.step[None] + (unary[row + 1] + beta[row + 1])[:, None, :], axis=2)
    owner_first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    log_z = np.logaddexp.reduce((alpha + beta)[owner_first], axis=1)
    node = np.exp(alpha + beta - log_z[:, None])
    truth = np.eye(2)[label]
    diff = (truth - node) * weight[:, None]
    d_unary = rows.T @ diff[:, BOILERPLATE]
    firsts = np.unique(owner_first)
    d_start = diff[firsts].sum(axis=0)
    nexts = np.flatnonzero(np.arange(len(rows)) != owner_first)
    pair = np.exp(alpha[nexts - 1][:, :, None] + field.step + (unary[nexts] + beta[nexts])[:, None, :] - log_z[nexts, None, None])
    true_pair = truth[nexts - 1][:, :, None] * truth[nexts][:, None, :]
    return d_unary, d_start, ((true_pair - pair) * weight[nexts, None, None]).sum(axis=0)


def stretches(sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the chains when no chain is longer than ``longest``, and the document of each."""
    found = [(n, d) for d, size in enumerate(sizes.tolist()) for n in [longest] * (size // longest) + [size % longest] if n]
    return np.array([n for n, _ in found], np.int64), np.array([d for _, d in found], np.int64)


def train(rows: np.ndarray, sizes: np.ndarray, quality: np.ndarray, rounds: int = 3, steps: int = 120, rate: float = 0.15,
          ridge: float = 1e-3) -> LineField:
    """The field from the lines of documents labelled good (1) or bad (0).

    All chains advance together, place by place, so the time follows from the number of lines
    and the longest chain; documents of more than ``LONGEST`` lines are several chains.
    """
    if not len(rows) or quality.min() == quality.max():
        return empty_field()
    sizes, of_document = stretches(sizes, LONGEST)
    quality = quality[of_document]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bad = quality[owner] == 0
    label = bad.astype(int)
    weight = np.where(bad, 0.5 / bad.sum(), 0.5 / (~bad).sum()) * len(rows)
    field = empty_field()
    for _ in range(rounds):
        params = [field.unary.copy(), field.start.copy(), field.step.copy()]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for k in range(1, steps + 1):  # Adam
            for i, g in enumerate(gradients(LineField(*params), rows, sizes, label, weight)):
                g = g / len(rows) - ridge * params[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] + rate * first[i] / (1 - 0.9 ** k) / (np.sqrt(second[i] / (1 - 0.999 ** k)) + 1e-8)
        field = LineField(*params)
        unary = rows @ field.unary
        worst = np.full(len(sizes), -np.inf)
        np.maximum.at(worst, owner, unary)
        label = np.where(bad, (viterbi(field, rows, sizes) == BOILERPLATE) | (unary >= worst[owner]), False).astype(int)
    return field


# --- operator -------------------------------------------------------------------------------

def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_docs: int = 3000, max_lines: int = 200_000, max_doc_lines: int = 4000) -> LineField:
    """Train on at most ``max_docs`` labelled documents and ``max_lines`` lines, half of each label, least hash of the id first.

    One row stands for each id (of its texts with lines, the one of least
    hash).  A document of more than ``max_doc_lines`` lines gives a run of so many, whose start its hash chooses.  Line
    counts reach the driver first; documents are taken in hash order while their lines fit into
    the label's half (one that does not fit is passed over), and their features follow.  Null ids
    and labels are passed over; an id labelled more than once takes its lowest
    label.  Without documents of both labels every line counts as content.
    """
    ids = (labels.filter(col(id_col).isNotNull() & col(label_col).isNotNull()).groupBy(col(id_col).alias("__id"))
           .agg(F.min(col(label_col).cast("int")).alias("label")))
    order = [F.xxhash64("__id"), F.col("__id")]
    picked = None
    for good in (True, False):
        part = ids.filter((F.col("label") > 0) == good).orderBy(*order).limit(max_docs // 2)
        picked = part if picked is None else picked.union(part)
    sample = (docs.select(col(id_col).alias("__doc"), col(text_col).alias("text"))
              .join(F.broadcast(picked), F.col("__doc") == F.col("__id")).select("__doc", "text", "label"))

    counted = (sample_lines(sample.withColumn("hash", F.xxhash64("text")), False, max_doc_lines).filter("n_lines > 0")
               .groupBy("__doc").agg(F.min(F.struct("hash", "n_lines")).alias("first"), F.min("label").alias("label"))
               .select("__doc", "label", "first.*", F.xxhash64("__doc").alias("place")).collect())  # one row per picked id
    chosen, left = [], {True: max_lines // 2, False: max_lines // 2}
    for r in sorted(counted, key=lambda r: (r["place"], r["__doc"])):
        if r["n_lines"] <= left[r["label"] > 0]:
            left[r["label"] > 0] -= r["n_lines"]
            chosen.append(r)
    if not chosen:
        return empty_field()
    kind = {f.name: f.dataType.simpleString() for f in sample.schema}["__doc"]
    rows = [(r["__doc"], r["hash"]) for r in chosen]
    wanted = docs.sparkSession.createDataFrame(rows, f"__id {kind}, __hash bigint")
    texts = (sample.withColumn("hash", F.xxhash64("text"))
             .join(F.broadcast(wanted), (F.col("__doc") == F.col("__id")) & (F.col("hash") == F.col("__hash")))
             .select("__doc", "text", "label", "hash"))
    # copies of one text have the same features
    got = sample_lines(texts, True, max_doc_lines).groupBy("__doc").agg(F.min("features").alias("features"), F.min("label").alias("label")).collect()
    got.sort(key=lambda r: r["__doc"])
    parts = [np.frombuffer(r["features"], np.float32).reshape(-1, len(FEATURES)) for r in got]
    return train(np.concatenate(parts).astype(np.float64), np.array([len(p) for p in parts], np.int64),
                 np.array([int(r["label"] > 0) for r in got]))


def run_of(rows: list, text: bytes, longest: int) -> list:
    """At most ``longest`` consecutive lines, from a place that the text's hash chooses."""
    start = zlib.crc32(text) % (len(rows) - longest + 1) if len(rows) > longest else 0
    return rows[start:start + longest]


def sample_lines(sample: DataFrame, features: bool, longest: int) -> DataFrame:
    """__doc, label and hash of each row with n_lines, or with the features of its lines instead."""
    def make():
        def work(texts: list[bytes | None]) -> list:
            rows = [run_of(line_features(t or b"")[0], t or b"", longest) for t in texts]
            return [[np.array(r, np.float32).tobytes() for r in rows]] if features else [[len(r) for r in rows]]
        return work
    return append_columns(sample, "text", make, [("features", "binary") if features else ("n_lines", "bigint")],
                          keep=["__doc", "label", "hash"])


FIELDS = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
          ("n_repeat_words", "bigint"), ("n_lines", "bigint"), ("n_content_words", "bigint")]


def quality(df: DataFrame, field: LineField, text_col: str = "text", min_words: int = 20, max_repeat_percent: int = 30,
            min_content_share: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Append the base measures, n_content_words, content_share, base_failed and kept to each row.

    base_failed: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` of them in repeated eight-word windows.  kept: not
    base_failed, and at least ``min_content_share`` of the words in content
    lines.  Null and empty texts have no words and fail the base.  Input
    columns named like a result give way; repeated rows are judged each; an
    empty table stays empty.
    """
    def make():
        def work(texts: list[bytes | None]) -> list:
            texts = [t or b"" for t in texts]
            words = [t.split() for t in texts]
            lines = [line_features(t) for t in texts]
            sizes = np.array([len(x[1]) for x in lines], np.int64)
            rows = np.array([r for x in lines for r in x[0]], np.float64).reshape(-1, len(FEATURES))
            label = viterbi(field, rows, sizes)
            counts = np.array([c for x in lines for c in x[1]], np.int64)
            content = np.bincount(np.repeat(np.arange(len(texts)), sizes), counts * (label == CONTENT), len(texts))
            return [[len(w) for w in words], list(map(word_chars, texts)), list(map(n_symbols, texts)), [x[2] for x in lines],
                    repeated_words(words), sizes, content.astype(np.int64)]
        return work
    out = append_columns(df, text_col, make, FIELDS, keep=keep)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    share = F.coalesce(F.try_divide(F.col("n_content_words"), F.col("n_words")), F.lit(0.0))
    return (out.withColumn("content_share", share).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= min_content_share)))
