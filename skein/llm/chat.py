"""Chat formatting from event logs: fold streamed deltas, edits and regenerations into messages, then render.

An event is (conv_id, msg_id, seq, kind, role, text); seq is of any orderable type. `start` opens a message and names
its role, `delta` appends text, `edit` replaces the message's text by its own, `regenerate` empties it. Folding groups
by conversation and message, so that a conversation of any length is spread over tasks and a task holds one message at
a time; only the order of messages, by the least seq and then msg_id, belongs to the conversation.

A message is rendered as `### role: text</turn>` and a line feed. In texts and roles a backslash stands before each
backslash, before each number sign of `###` and after the `<` of `</turn>`, in roles also before colons and line feeds:
neither control string occurs inside a text any more, and Reader gives the same turns again from the whole output of a
conversation, in chunks of any size. The loss mask is a range of the piece: the text of a turn of the assistant.

Odd inputs: null texts and roles are empty; a message without `start` has an empty role; events of other kinds and
deltas before the last edit or regeneration have no effect; null conversation ids form one conversation; null turns come
first; turns of equal number are ordered by role, then by a hash of the text; repeated rows are turns of their own; texts
of any length are whole; other columns, whatever their names, are left out; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELTA_CHARS = 512
LEARNED_ROLE = "assistant"
END = "</turn>\n"
HEAD = re.compile(r"### ((?:[^\\:]|\\.)*+): ", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)
#: How often a turn of the log that events_of() makes was drafted otherwise before: every n-th turn was edited, every m-th generated again.
EDITED, REGENERATED = 3, 4


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("###"), F.lit("\\#\\#\\#"))
    return F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def events_of(turns: DataFrame, chars: int = DELTA_CHARS) -> DataFrame:
    """An event log that leads to finished turns (conv_id, turn, role, text).

    Each turn has a start and streamed deltas. By the turn's hash some were streamed as a draft (the text backwards)
    and generated again, and some were edited: the text so far, up to its middle, replaced the draft, the rest followed."""
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    alike = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    each = alike.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    each = each.withColumn("hash", F.xxhash64("text")).withColumn("msg_id", F.struct("turn", "role", "hash", "copy"))

    def event(*values: Column) -> Column:
        return F.struct(*[v.alias(name) for v, name in zip(values, ("step", "part", "kind", "role", "text"), strict=True)])

    def deltas(step: int, text: Column) -> Column:
        parts = F.sequence(F.lit(0), F.floor(F.char_length(text) / chars).cast("int"))
        return F.transform(parts, lambda i: event(F.lit(step), i, F.lit("delta"), F.lit(""), F.substring(text, i * chars + 1, F.lit(chars))))

    draft, half = F.reverse(F.substring("text", 1, 2 * chars)), (F.char_length("text") / 2).cast("int")
    one = lambda step, kind, role, text: F.array(event(F.lit(step), F.lit(0), F.lit(kind), role, text))
    none = F.array().cast("array<struct<step:int,part:int,kind:string,role:string,text:string>>")
    start = one(0, "start", F.col("role"), F.lit(""))
    again = F.when(F.pmod("hash", F.lit(REGENERATED)) == 0, F.concat(deltas(1, draft), one(2, "regenerate", F.lit(""), F.lit("")))).otherwise(none)
    edited = F.concat(deltas(3, draft), one(4, "edit", F.lit(""), F.substring("text", F.lit(1), half)), deltas(5, F.substring("text", half + 1, F.char_length("text"))))
    body = F.when(F.pmod(F.shiftright("hash", 8), F.lit(EDITED)) == 0, edited).otherwise(deltas(5, F.col("text")))
    flat = each.select("conv_id", "turn", "msg_id", F.explode(F.concat(start, again, body)).alias("e"))
    return flat.select("conv_id", "msg_id", F.struct("turn", "e.step", "e.part").alias("seq"), "e.kind", "e.role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, msg_id, first_seq, role, text): the final messages."""
    reset = F.col("kind").isin("edit", "regenerate")
    own = F.when(F.col("kind").isin("delta", "edit"), F.struct("seq", F.coalesce("text", F.lit("")).alias("text")))
    messages = events.groupBy("conv_id", "msg_id").agg(
        F.min("seq").alias("first_seq"),
        F.min_by("role", F.when(F.col("kind") == "start", F.col("seq"))).alias("role"),
        F.max(F.when(reset, F.col("seq"))).alias("reset"),
        F.collect_list(own).alias("parts"),
    )
    live = F.filter("parts", lambda p: F.col("reset").isNull() | (p["seq"] >= F.col("reset")))
    text = F.array_join(F.transform(F.array_sort(live), lambda p: p["text"]), "")
    return messages.select("conv_id", "msg_id", "first_seq", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """(conv_id, first_seq, msg_id, piece, loss_start, loss_end): a conversation's output is its pieces in order of first_seq and msg_id; the loss range is null for turns that aren't learned."""
    role = F.replace(F.replace(escaped(F.col("role")), F.lit(":"), F.lit("\\:")), F.lit("\n"), F.lit("\\\n"))
    head, body = F.concat(F.lit("### "), role, F.lit(": ")), escaped(F.col("text"))
    learned = F.col("role") == learned_role
    return messages.select(
        "conv_id",
        "first_seq",
        "msg_id",
        F.concat(head, body, F.lit("</turn>\n")).alias("piece"),
        F.when(learned, F.char_length(head)).alias("loss_start"),
        F.when(learned, F.char_length(head) + F.char_length(body)).alias("loss_end"),
    )


class Reader:
    """Reads the whole output of a conversation, in chunks as they come: feed() gives each turn that is complete, as (role, text, begin, end), where its escaped text lies in the output."""

    def __init__(self) -> None:
        self.rest, self.at = "", 0

    def feed(self, chunk: str) -> Iterator[tuple[str, str, int, int]]:
        self.rest += chunk
        begin = 0
        while (end := self.rest.find(END, begin)) >= 0:
            head = HEAD.match(self.rest, begin)
            if not head:
                raise ValueError("not a rendered turn")
            yield unescaped(head[1]), unescaped(self.rest[head.end() : end]), self.at + head.end(), self.at + end
            begin = end + len(END)
        self.rest, self.at = self.rest[begin:], self.at + begin

    def close(self) -> None:
        if self.rest:
            raise ValueError("the last turn has no end")


class _Digest:
    """What the output of one conversation reads back as; holds hashes, counts and at most one unfinished turn."""

    def __init__(self, key: int | None) -> None:
        self.key, self.reader, self.turns, self.learned = key, Reader(), hashlib.sha256(), hashlib.sha256()
        self.n = self.loss = self.chars = 0
        self.masked: list[tuple[int, int]] = []

    def add(self, piece: str, low: int | None, high: int | None) -> None:
        if low is not None:
            self.masked.append((self.chars + low, self.chars + high))
        self.chars += len(piece)
        for role, text, begin, end in self.reader.feed(piece):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if self.masked and self.masked[0] == (begin, end):  # the mask is that of the output, found again by its offsets
                del self.masked[0]
                self.learned.update(text.encode())
                self.loss += len(text)

    def row(self) -> tuple:
        self.reader.close()
        if self.masked:
            raise ValueError("the loss mask is not the text of turns")
        return self.key, self.n, self.turns.hexdigest(), self.loss, self.learned.hexdigest(), self.chars


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, from its pieces in order."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    own: _Digest | None = None
    for batch in batches:
        out = []
        for conv, piece, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own is None or conv != own.key:
                out += [own.row()] if own else []
                own = _Digest(conv)
            own.add(piece, low, high)
        if out:
            yield table(out)
    if own:
        yield table([own.row()])


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation what its whole output reads back as. Pieces stream through in order: a digest of a text is sequential, so one conversation stays in one task, which holds one piece at a time."""
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "first_seq", "msg_id").select("conv_id", "piece", "loss_start", "loss_end")
    return ordered.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted(turns: DataFrame) -> DataFrame:
    """Rendered pieces of a table of turns."""
    return render(fold(events_of(turns)))
