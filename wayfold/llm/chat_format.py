"""Chat formatting with a grammar that reads back what it wrote.

A conversation is its turns one after the other, each between the marks of its role;
inside marks a text may hold anything but marks, and ESC before a character makes that
character plain. Every rendered turn is parsed again by the same deterministic parser
that readers use and compared with its source. Where they differ, the conflicting
content is escaped (first marks and ESC themselves, then every character) until they
are identical. A turn's end shows from the turn alone, so what holds for turns holds for
their sequence.

Turns are sorted over the cluster by conversation and turn and rendered where they lie. A
conversation is written in pieces of whole turns, most in one; one that has more turns
than a task takes spans several tasks. Pieces that are conversations of their own are
read back as they are; only the others are brought together, and read as a stream.

Defined results: null role and null text count as empty; turns go by number, nulls first,
and by role and text where they tie; rows that repeat a turn are turns of their own;
rows without a conversation id are one conversation without an id; texts have no upper
length; roles beside user, assistant and system are named inside their marks; an empty
table gives an empty table. Other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, write_table

#: Marks around the text of a role's turns; any other role's name stands between NAMED[0]
#: and NAMED[1].
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
NAMED = ("[TURN]", "[AS]", "[/TURN]")
ESC = "␛"
#: All strings that only the template may write.
CONTROL = [mark for pair in MARKS.values() for mark in pair] + list(NAMED)

_CONTROL = "|".join(map(re.escape, CONTROL))
_CONFLICT = re.compile(f"{ESC}|{_CONTROL}")
_NEXT = re.compile(f"{ESC}.|{_CONTROL}", re.DOTALL)
_ESCAPED = re.compile(f"{ESC}(.)", re.DOTALL)
_OPENS = re.compile("|".join(re.escape(x) for x in (*(a for a, _ in MARKS.values()), NAMED[0])))
_ROLE_OF = {a: role for role, (a, _) in MARKS.items()}

#: Characters of a piece; the turn that reaches it is the piece's last.
PIECE = 1 << 20


def escape_conflicts(text: str) -> str:
    """ESC after the first character of each mark, and before each ESC."""
    return _CONFLICT.sub(lambda m: m[0][0] + ESC + m[0][1:], text)


def escape_all(text: str) -> str:
    return "".join(ESC + c for c in text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if ESC in text else text


def _wrap(role: str, text: str, name: str) -> tuple[str, int]:
    """A turn between its marks, and where its text begins."""
    if role in MARKS:
        a, z = MARKS[role]
    else:
        a, z = NAMED[0] + name + NAMED[1], NAMED[2]
    return a + text + z, len(a)


def _body(s: str, at: int) -> tuple[str, str, int]:
    """The plain text from ``at`` to the next mark, that mark, and where it ends."""
    start = at
    while m := _NEXT.search(s, at):
        at = m.end()
        if m[0][0] != ESC:
            return unescape(s[start : m.start()]), m[0], at
    raise ValueError("a turn has no end")


def parse(s: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; raises for one that isn't of the grammar."""
    out, at = [], 0
    while at < len(s):
        m = _OPENS.match(s, at)
        if not m:
            raise ValueError("no turn begins here")
        at = m.end()
        if m[0] in _ROLE_OF:
            role, close = _ROLE_OF[m[0]], MARKS[_ROLE_OF[m[0]]][1]
        else:
            role, mark, at = _body(s, at)
            if mark != NAMED[1] or role in MARKS:
                raise ValueError("a role has no end")
            close = NAMED[2]
        text, mark, at = _body(s, at)
        if mark != close:
            raise ValueError("another mark inside a turn")
        out.append((role, text))
    return out


def _reads_back(turn: str, role: str, text: str) -> bool:
    try:
        return parse(turn) == [(role, text)]
    except ValueError:
        return False


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn that reads back as it was, and where its text begins and ends in it."""
    for escape in (str, escape_conflicts, escape_all):
        own = escape(text)
        turn, start = _wrap(role, own, escape(role))
        if _reads_back(turn, role, text):
            return turn, start, start + len(own)
    raise AssertionError("a text with every character escaped must read back")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
OUT = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss", SPANS)])


def _rows_out(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the conversations of a task's sorted turns. The first and the last
    conversation may go on in another task, so their pieces aren't said to be whole."""
    task = TaskContext.get().partitionId() << 33
    done, held, number = 0, [], 0
    conv, parts, spans, size, turns = object(), [], [], 0, 0
    first, pieces = True, 0

    def flush(whole: bool) -> None:
        nonlocal number, parts, spans, size, turns, done
        held.append({"conv_id": conv, "piece": task + number, "whole": whole, "n_turns": turns, "formatted": "".join(parts), "loss": spans})
        number, done = number + 1, done + size
        parts, spans, size, turns = [], [], 0, 0

    for batch in batches:
        for c, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if c != conv:
                if turns:
                    flush(whole=not first and not pieces)
                    first = False
                conv, pieces = c, 0
            elif size >= PIECE:
                flush(whole=False)
                pieces += 1
            turn, start, end = render(role, text)
            if role == "assistant":
                spans.append({"start": size + start, "end": size + end})
            parts.append(turn)
            size += len(turn)
            turns += 1
            if done >= PIECE or len(held) >= 512:
                yield _rows_out(held, OUT)
                held.clear()
                done = 0
    if turns:
        flush(whole=False)
    if held:
        yield _rows_out(held, OUT)


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A written table of ``conv_id, piece, whole, n_turns, formatted, loss``: the
    conversations in pieces of whole turns, to be read in the order of ``piece``; ``loss``
    holds where the assistant's texts begin and end in ``formatted``, in code points. A
    piece that is ``whole`` is known to be a conversation of its own."""
    small_batches(turns.sparkSession)
    own = turns.select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    # ranges are told by short columns; turns that tie in all of these share a task
    rows = own.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, piece long, whole boolean, n_turns long, formatted string, loss array<struct<start: long, end: long>>"
    return write_table(rows.select("conv_id", "role", "text").mapInArrow(_format, schema), "chats")


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, held = object(), None, []

    def flush() -> None:
        if state:
            held.append({"conv_id": conv, "n_turns": state["turns"], "turns_sha256": state["all"].hexdigest(), "loss_chars": state["loss"], "loss_sha256": state["own"].hexdigest(), "formatted_chars": state["chars"]})

    for batch in batches:
        for c, text, spans in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if c != conv:
                flush()
                conv, state = c, {"turns": 0, "all": hashlib.sha256(), "loss": 0, "own": hashlib.sha256(), "chars": 0}
            for role, said in parse(text):
                state["all"].update(f"{role}\n{said}\n".encode())
                state["turns"] += 1
            for span in spans:
                said = unescape(text[span["start"] : span["end"]])
                state["own"].update(said.encode())
                state["loss"] += len(said)
            state["chars"] += len(text)
        if len(held) >= 1024:
            yield _rows_out(held, DIGEST)
            held.clear()
    flush()
    if held:
        yield _rows_out(held, DIGEST)


def read_back(pieces: DataFrame) -> DataFrame:
    """What a table of :func:`format_chats` says, a row for each conversation: its turns,
    a digest of their roles and texts, the characters under the loss mask with a digest,
    and the characters of the formatted text."""
    small_batches(pieces.sparkSession)
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = ["conv_id", "formatted", "loss"]
    whole = pieces.where("whole").select(*columns).mapInArrow(_read_back, schema)
    # a digest is made in order, so a conversation's pieces pass one task, one at a time
    parts = pieces.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return whole.unionByName(parts.select(*columns).mapInArrow(_read_back, schema))
