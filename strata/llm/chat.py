"""Chat formatting: conversations rebuilt from an event log, then rendered for training.

An event has a conversation, the message it belongs to, its place in that message
(seq), a kind, a role and a text:

- ``open`` starts the message with its role; a later one sets the role anew.
- ``delta`` appends its text.
- ``edit`` replaces what was written so far.
- ``regenerate`` discards it; new deltas follow.
- ``remove`` takes the message out, until an ``open`` brings it back, empty.

Other kinds change nothing. Messages stand in the order of their keys, null first;
events with equal seq are taken by kind, role and text.

The log is range-partitioned by (conversation, message) and sorted by seq within it, so
one shuffle brings the events of a message together and a conversation with a third
of all events is dealt to many tasks, each with a run of its messages. A task folds
message by message and writes parts of about ``PART_CHARS`` characters: the rendered
turns and the spans of the loss mask. Parts are ordered by (chunk, part), chunk being
the number of the range.

Template of a turn::

    ### role:
    text
    </turn>

In roles and texts a backslash is doubled, and one is put inside ``</turn>`` and between
two ``#``, so neither control string occurs in them; a line feed in a role is written
``\\n``. ``unescape`` reverses this. The loss mask covers the escaped texts of
``assistant`` turns.

Defined results: null texts and roles are empty; a null conversation is one
conversation; a conversation without messages has no part; a message may be empty; rows that
repeat in ``events_of`` are turns of their own, turns with equal numbers stand by role and text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm.common import prepare

LEARNED = "assistant"
DELTA_CHARS = 1024
PART_CHARS = 1 << 18
# fixed values: the template's control strings
HEAD, END = "### ", "\n</turn>\n"
_TURN = re.compile(r"### ([^\n]*):\n(.*?)\n</turn>\n", re.S)
_PARTS = "conv {conv}, chunk int, part int, text string, loss array<struct<start:int,end:int>>, turns int"


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>")
    return re.sub("#(?=#)", r"#\\", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def fold(events: Iterable[tuple[str, str, str]]) -> tuple[str, str] | None:
    """(role, text) of a message from its events (kind, role, text) in order, or None."""
    role, pieces, there = "", [], False
    for kind, who, text in events:
        if kind == "open":
            role, there = who or "", True
        elif kind == "delta":
            pieces.append(text or "")
            there = True
        elif kind == "edit":
            pieces, there = [text or ""], True
        elif kind == "regenerate":
            pieces = []
        elif kind == "remove":
            pieces, there = [], False
    return (role, "".join(pieces)) if there else None


class _Part:
    """The turns of one part of a conversation, as they are rendered."""

    def __init__(self, learned: str):
        self.learned, self.pieces, self.size, self.loss, self.turns = learned, [], 0, [], 0

    def add(self, role: str, text: str) -> None:
        head, body = f"{HEAD}{escape_role(role)}:\n", escape(text)
        start = self.size + len(head)
        if role == self.learned:
            self.loss.append({"start": start, "end": start + len(body)})
        self.pieces += [head, body, END]
        self.size = start + len(body) + len(END)
        self.turns += 1


def _render(batches: Iterable[pa.RecordBatch], conv_type: pa.DataType, learned: str,
            part_chars: int = PART_CHARS) -> Iterator[pa.RecordBatch]:
    """Columns conv, key (of the message), kind, role, text, in order: rows of parts."""
    from pyspark import TaskContext

    chunk = TaskContext.get().partitionId()
    done: list[tuple] = []
    weight = number = 0
    conv = key = part = None
    events: list[tuple] = []

    def close_message():
        message = fold(events)
        if message:
            part.add(*message)
        events.clear()

    def close_part():
        nonlocal part, number, weight
        if part.turns:
            done.append((conv, chunk, number, "".join(part.pieces), part.loss, part.turns))
            number, weight = number + 1, weight + part.size
        part = _Part(learned)

    def batch():
        nonlocal weight
        columns = list(zip(*done))
        done.clear()
        weight = 0
        types = [conv_type, pa.int32(), pa.int32(), pa.string(), _LOSS_TYPE, pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          ["conv", "chunk", "part", "text", "loss", "turns"])

    for rows in batches:
        for row_conv, row_key, kind, role, text in zip(*(c.to_pylist() for c in rows.columns)):
            if part is None or row_conv != conv or row_key != key:
                if part is not None:
                    close_message()
                    if row_conv != conv or part.size >= part_chars:
                        close_part()
                    if row_conv != conv:
                        number = 0
                    if weight >= 8 * PART_CHARS or len(done) >= 1024:
                        yield batch()
                else:
                    part = _Part(learned)
                conv, key = row_conv, row_key
            events.append((kind, role, text))
    if part is not None:
        close_message()
        close_part()
    if done:
        yield batch()


def format_chats(log: DataFrame, *, conv_col: str = "conv_id", message_col: str = "message", seq_col: str = "seq",
                 kind_col: str = "kind", role_col: str = "role", text_col: str = "text",
                 learned: str = LEARNED, part_chars: int = PART_CHARS) -> DataFrame:
    """The formatted conversations of an event log, in parts: conv (the conversation), chunk,
    part, text, loss (spans of the mask, code points of the part's text) and turns. A part
    ends with the turn that brings it to ``part_chars`` characters."""
    spark = log.sparkSession
    prepare(spark)
    names = {"conv": conv_col, "message": message_col, "seq": seq_col, "kind": kind_col, "role": role_col,
             "text": text_col}
    rows = log.select(*[F.col(f"`{c}`").alias(name) for name, c in names.items()])
    rows = rows.repartitionByRange("conv", "message").sortWithinPartitions(
        "conv", "message", "seq", "kind", "role", "text")
    # a task tells messages apart by a text of their key, whatever its type
    key = F.to_json(F.struct("message")).alias("key")
    conv_type = rows.schema["conv"].dataType
    arrow_type = to_arrow_type(conv_type)
    return rows.select("conv", key, F.col("kind").cast("string"), F.col("role").cast("string"),
                       F.col("text").cast("string")).mapInArrow(
        lambda batches: _render(batches, arrow_type, learned, part_chars), _PARTS.format(conv=conv_type.simpleString()))


def read_back(text: str, loss: list[dict]) -> tuple[list[tuple[str, str]], list[str]]:
    """The turns (role, text) of a part and the texts under its mask, unescaped."""
    turns, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError("not a formatted conversation")
    return turns, [unescape(text[s["start"]:s["end"]]) for s in loss]


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, loss: list[dict]) -> None:
        turns, learned = read_back(text, loss)
        for role, said in turns:
            self.turns.update(f"{role}\n{said}\n".encode())
        for said in learned:
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.n_turns += len(turns)
        self.chars += len(text)

    def row(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


HELD_PARTS = 8              # parts of a conversation a task keeps before it passes them on
_LOSS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_DIGESTS = {"n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
            "loss_sha256": pa.string(), "formatted_chars": pa.int64()}
_DIGEST_DDL = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _batches_of(rows: Iterable[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[3] or "")
        if len(held) >= 1024 or weight >= 8 * PART_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _digest_inner(rows: Iterable[tuple]) -> Iterator[tuple]:
    """From parts (conv, chunk, part, text, loss): a digest for each conversation that begins and
    ends within the task; the parts of the others, and of long ones, as they are."""
    none = (None,) * len(_DIGESTS)
    held: list[tuple] = []
    first, passing, conv, started = True, True, None, False

    def finish(complete: bool) -> Iterator[tuple]:
        if complete and held:
            digest = _Digest()
            for row in held:
                digest.add(row[3], row[4])
            yield (conv, None, None, None, None, *digest.row())
        else:
            yield from (row + none for row in held)
        held.clear()

    for row in rows:
        if not started or row[0] != conv:
            yield from finish(not first)
            first, conv, started, passing = not started, row[0], True, False
        if passing or first:
            yield row[:5] + none
            continue
        held.append(row[:5])
        if len(held) > HELD_PARTS:
            passing = True
            yield from finish(False)
    yield from finish(False)


def _digest_rest(rows: Iterable[tuple]) -> Iterator[tuple]:
    """One row (conv and its digests) a conversation, from its digest or its parts in order."""
    conv, digest = None, None
    for row in rows:
        if digest is not None and row[0] != conv:
            yield (conv, *digest.row())
            digest = None
        if row[3] is None:
            yield (row[0], *row[5:])
            continue
        if digest is None:
            conv, digest = row[0], _Digest()
        digest.add(row[3], row[4])
    if digest is not None:
        yield (conv, *digest.row())


def digests(parts: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations (columns of ``format_chats``), one
    row a conversation: conv, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars.

    Hashes are sequential, so a conversation's parts meet in one task, as a stream. Only
    conversations at the ends of a range, and those of more than ``HELD_PARTS`` parts,
    send their texts there; of all others the digests travel."""
    kind = parts.schema["conv"].dataType
    conv_type, conv_ddl = to_arrow_type(kind), kind.simpleString()
    some_types = [conv_type, pa.int32(), pa.int32(), pa.string(), _LOSS_TYPE, *_DIGESTS.values()]
    some_names = ["conv", "chunk", "part", "text", "loss", *_DIGESTS]
    some = parts.select("conv", "chunk", "part", "text", "loss").mapInArrow(
        lambda batches: _batches_of(_digest_inner(_rows_of(batches)), some_names, some_types),
        f"conv {conv_ddl}, chunk int, part int, text string, loss array<struct<start:int,end:int>>, {_DIGEST_DDL}")

    def finish(batches):
        # the fourth column of these rows is a number; batches are bounded by rows alone
        rows, names, types = [], ["conv", *_DIGESTS], [conv_type, *_DIGESTS.values()]
        for row in _digest_rest(_rows_of(batches)):
            rows.append(row)
            if len(rows) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return some.repartition("conv").sortWithinPartitions("conv", "chunk", "part").mapInArrow(
        finish, f"conv {conv_ddl}, {_DIGEST_DDL}")


def events_of(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """The event log of a table with one row a turn: conv_id, message (turn, role, hash of the
    text and the row's number, so that rows that repeat stay apart), seq, kind, role and
    text. Each turn is an ``open`` and ``delta`` events of ``DELTA_CHARS`` characters."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.col(f"`{role_col}`").cast("string").alias("role"), text.alias("text"),
        F.monotonically_increasing_id().alias("row"))
    pieces = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % DELTA_CHARS), F.lit(0))
    opened = F.array(F.struct(F.lit("open").alias("kind"), F.col("role").alias("role"), F.lit("").alias("text")))
    added = F.transform(pieces, lambda p: F.struct(
        F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), p.alias("text")))
    message = F.struct("turn", "role", F.xxhash64("text").alias("hash"), "row").alias("message")
    return rows.select("conv_id", message, F.posexplode(F.concat(opened, added)).alias("seq", "e")).select(
        "conv_id", "message", "seq", "e.*")
