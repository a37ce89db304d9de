"""Chat formatting from an event log.

A conversation is a log of events (conv_id, turn, copy, seq, kind, role, text,
start, stop); ``seq`` orders the whole conversation:

- ``start`` opens the message with a role, ``delta`` appends streamed text;
- ``edit`` replaces the characters [start, stop) by text (both null: all);
- ``regenerate`` throws the draft away, later deltas build the new one; what was said so far in
  later turns of the conversation answered the draft and goes with it;
- ``retract`` removes the message unless a later event opens it again.

The log is partitioned by conversation and sorted by sequence.  A conversation may hold a
large part of all events, so its log is cut into stretches of ``STRETCH`` sequence
numbers: the least turn regenerated later is a running minimum from the end of a stretch, and a row
for each stretch carries it across.  The events that are left touch one message each, so
they are dealt by message, in sequence, and folded; the fold streams over sorted rows and holds one message at a
time.  Rendering gives a row per message; a conversation's string is their concatenation by (turn, copy).

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts every
``<|`` gets a backslash after ``<`` (one more where backslashes stand there
already), which :func:`unescape` takes away again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rivulet.llm.batches import map_batches

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Sequence numbers in one stretch of a conversation's log.
STRETCH = 1 << 16


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def render(role: str, text: str, trained: str = "assistant") -> tuple[str, int | None, int | None]:
    """The formatted message and, for the trained role, where its text starts and stops (the loss mask)."""
    head, body = f"{OPEN}{escape_role(role)}\n", escape(text)
    start, stop = (len(head), len(head) + len(body)) if role == trained else (None, None)
    return f"{head}{body}{CLOSE}\n", start, stop


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted message."""
    head, _, rest = formatted.removeprefix(OPEN).partition("\n")
    return unescape_role(head), unescape(rest[:-len(CLOSE) - 1])


class Message:
    """Folds the events of one message."""

    def __init__(self) -> None:
        self.role, self.parts, self.open = "", [], False

    def take(self, kind: str | None, role: str | None, text: str | None, start: int | None, stop: int | None) -> None:
        text = text or ""
        if kind == "start":
            self.role, self.parts, self.open = role or "", [text], True
        elif kind == "delta":
            self.parts.append(text)
            self.open = True
        elif kind == "regenerate":
            self.parts = []
        elif kind == "edit":
            whole = "".join(self.parts)
            a, b = 0 if start is None else max(0, start), len(whole) if stop is None else max(0, stop)
            self.parts = [whole[:a], text, whole[max(a, b):]]
        elif kind == "retract":
            self.parts, self.open = [], False


def without_dropped_turns(log: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The events that no later regeneration of an earlier turn of their conversation drops.

    A null turn comes before all others; a null sequence number comes first.
    """
    turn = F.struct("turn")  # compares with nulls first
    regenerated = F.when(F.col("kind") == "regenerate", turn)
    cut = log.withColumn("stretch", F.floor(F.coalesce("seq", F.lit(0).cast("decimal(38,0)")) / stretch).cast("decimal(38,0)"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    behind = (cut.groupBy("conv_id", "stretch").agg(F.min(regenerated).alias("least"))  # a row for each stretch
              .select("conv_id", "stretch", F.min("least").over(later).alias("behind")).filter("behind is not null"))
    # ranges need one number to order by: the place within the stretch
    place = (F.col("seq") - F.col("stretch") * F.lit(stretch)).cast("bigint")
    here = Window.partitionBy("conv_id", "stretch").orderBy(-F.coalesce("place", F.lit(-1))).rangeBetween(Window.unboundedPreceding, -1)
    seen = cut.withColumn("place", place).withColumn("within", F.min(regenerated).over(here))
    behind = behind.select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), "behind")
    return (seen.join(behind, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s")), "left")
            .filter(~F.coalesce(turn > F.col("within"), F.lit(False)) & ~F.coalesce(turn > F.col("behind"), F.lit(False)))
            .select(*log.columns))


def same(a: tuple | None, b: tuple) -> bool:
    """Equal keys; NaN equals itself."""
    return a is not None and all(x == y or (x != x and y != y) for x, y in zip(a, b))


def format_events(events: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, turn, copy, formatted, mask_start, mask_stop), a row per message that is left.

    Null texts append nothing, a null role is empty, unknown or null kinds are
    passed over, events of equal sequence apply in the order of kind, text and
    range (and do not drop each other's turns); repeated events apply each.  Conversation ids may
    be of any type that orders; null ids, turns and copies are keys like others.  Sequences are whole numbers of up to 38 digits.  An empty log gives no
    rows; other columns are not read.
    """
    keys = ["conv_id", "turn", "copy"]
    schema = T.StructType([T.StructField("conv_id", events.schema["conv_id"].dataType), T.StructField("turn", T.LongType()),
                           T.StructField("copy", T.LongType()), T.StructField("formatted", T.StringType()),
                           T.StructField("mask_start", T.LongType()), T.StructField("mask_stop", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, message, kind = None, None, None

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)],
                                              names=[*keys, "formatted", "mask_start", "mask_stop"])

        for batch in batches:
            kind = batch.column(0).type
            out: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if message is None or not same(key, row[:3]):
                    if message is not None and message.open:
                        out.append((*key, *render(message.role, "".join(message.parts), trained)))
                    key, message = row[:3], Message()
                message.take(*row[4:])
            yield packed(out)
        if message is not None and message.open:
            yield packed([(*key, *render(message.role, "".join(message.parts), trained))])

    log = events.select("conv_id", *[F.col(c).cast("bigint").alias(c) for c in ("turn", "copy")], F.col("seq").cast("decimal(38,0)").alias("seq"),
                        *[F.col(c).cast("string").alias(c) for c in ("kind", "role", "text")],
                        *[F.col(c).cast("bigint").alias(c) for c in ("start", "stop")])
    order = [F.asc_nulls_first("seq"), "kind", "text", "start", "stop"]
    dealt = without_dropped_turns(log).repartition(*keys).sortWithinPartitions(*keys, *order)
    return map_batches(dealt, run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """Read the messages back: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Streams over each conversation in order of (turn, copy), nulls first, and keeps only running hashes.  A null id is an id like others;
    an empty table gives no rows; other columns are not read.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [formatted.schema["conv_id"].dataType, T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> tuple:
            return key, turns, all_hash.hexdigest(), loss, loss_hash.hexdigest(), chars

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)], names=names)

        begun, kind = False, None
        for batch in batches:
            out, kind = [], batch.column("conv_id").type
            for conv, text, start, stop in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "mask_start", "mask_stop")]):
                if not begun or not same((key,), (conv,)):
                    if begun:
                        out.append(row())
                    key, turns, loss, chars, begun = conv, 0, 0, 0, True
                    all_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
                role, said = parse(text)
                turns, chars = turns + 1, chars + len(text)
                all_hash.update(f"{role}\n{said}\n".encode())
                if start is not None:
                    masked = unescape(text[start:stop])
                    loss += len(masked)
                    loss_hash.update(masked.encode())
            yield packed(out)
        if begun:
            yield packed([row()])

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "copy")
    return map_batches(dealt, run, schema)


def replayed(conversations: DataFrame) -> DataFrame:
    """An event log whose fold gives back the rows (conv_id, turn, role, text).

    Assistants stream a draft that the next turn answers too early, regenerate (which drops that answer), then
    stream their text in four deltas; users stream theirs and cut a slip off again by an edit; other
    roles stream a mirrored text that an edit replaces.  Rows of one
    conversation and turn are told apart by ``copy``; sequence numbers rise with turn and copy.
    """
    again = Window.partitionBy("conv_id", "turn").orderBy(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
                                F.col("text").cast("string").alias("text")).withColumn("copy", F.row_number().over(again).cast("bigint"))
    n, none = F.length("t"), F.lit(None)

    def event(kind: str, text=none, start=none, stop=none, later: int = 0):
        return F.struct(F.lit(kind).alias("kind"), text.cast("string").alias("text"), start.cast("bigint").alias("start"),
                        stop.cast("bigint").alias("stop"), F.lit(later).alias("later"))

    part = F.ceil(n / 4).cast("int")
    stream = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: event("delta", F.substr("t", i * part + 1, part)))
    slip = F.lit(" <|oops|>")
    early = F.when(F.col("turn") < 2 ** 63 - 1, F.array(event("start", later=1), event("delta", F.lit("an answer to the draft"), later=1))) \
        .otherwise(F.filter(F.array(event("start")), lambda e: F.lit(False)))
    log = (F.when(F.col("role") == "assistant", F.concat(F.array(event("start"), event("delta", F.left("t", part))), early,
                                                         F.array(event("regenerate")), stream))
           .when(F.col("role") == "user", F.concat(F.array(event("start")), stream, F.array(
               event("delta", slip), event("edit", F.lit(""), n, n + F.length(slip)))))
           .otherwise(F.array(event("start"), event("delta", F.reverse("t")), event("edit", F.col("t")))))
    whole = lambda c: c.cast("decimal(38,0)")
    # a null turn comes first, so its numbers lie below those of all others
    base = (F.coalesce(whole(F.col("turn")), F.lit("-9223372036854775809").cast("decimal(38,0)")) * whole(F.lit(1 << 40))).cast("decimal(38,0)")
    seq = (base + whole(F.col("copy")) * whole(F.lit(16)) + whole(F.col("place"))).cast("decimal(38,0)")
    return (rows.withColumn("t", F.coalesce("text", F.lit(""))).select("conv_id", "turn", "copy", "role", F.posexplode(log).alias("place", "e"))
            .select("conv_id", F.when(F.col("e.later") == 1, F.col("turn") + 1).otherwise(F.col("turn")).alias("turn"),
                    F.when(F.col("e.later") == 1, F.lit(0)).otherwise(F.col("copy")).cast("bigint").alias("copy"),
                    seq.alias("seq"), "e.kind", "role", "e.text", "e.start", "e.stop"))
