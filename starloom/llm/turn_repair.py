"""Repair of the turn structure of conversations at least cost, streamed in the order of turns.

A conversation goes through one task as a sorted stream, so none is ever held
whole.  The first stream runs from the last turn to the first and carries the
least cost to finish from each state; of every row it leaves a byte, the best
edit in each of the four states.  These back pointers are written to the shared
folder in blocks.  The second stream runs forward along them and makes the
edits, with the texts passing by.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.sources.staging import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 1 << 16  # rows whose back pointers are one written value
# What a well-formed conversation has said last: nothing, system, user, assistant.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_SAYS = {_NOTHING: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}  # whom the state calls for
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_FINISH = (0, 2 * INSERT, INSERT, 0)  # cost from each state after the last row
_LETTERS = "DIKR"
_FINE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_STATS = ", ".join(f"{c} long" for c in _COUNTS)
_POINTERS = f"_conv string, turn long, role string, _h1 long, _h2 long, _kind long, choices binary, {_STATS}"
_EDITS = f"_conv string, {_STATS}, n long, edit string, turn long, role string, text string"
_SUMMARY = f"_conv string, {_STATS}, audit string, repaired string"


class Costs:
    """The step of the dynamic programme, remembered: cost vectors differ by bounded amounts, so they are few."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def step(self, after: tuple[int, ...], said: int, fault: int) -> tuple[tuple[int, ...], int, int]:
        """Costs to finish from each state before a row, less their minimum; that minimum; the best edits as two bits each.

        ``after`` has the costs behind the row, ``said`` is its role's state (0: another role).
        """
        key = (after, said, fault)
        if key not in self.known:
            self.known[key] = self._step(*key)
        return self.known[key]

    @staticmethod
    def _step(after: tuple[int, ...], said: int, fault: int) -> tuple[tuple[int, ...], int, int]:
        extra = TRUNCATED if fault == _TRUNCATED else 0
        ways: list[dict[str, int]] = []
        for state in range(4):
            way = {"D": DELETE + after[state]}
            if fault not in (_BLANK, _DUPLICATE):
                if said and (said == _SAYS[state] or (said == _SYSTEM and state == _NOTHING)):
                    way["K"] = KEEP + extra + after[said]
                way["R"] = REROLE + extra + after[_SAYS[state]]
            ways.append(way)
        best = [min(w.values()) for w in ways]
        best[_USER], best[_ASSISTANT] = min(best[_USER], INSERT + best[_ASSISTANT]), min(best[_ASSISTANT], INSERT + best[_USER])
        for state in (_NOTHING, _SYSTEM):
            best[state] = min(best[state], INSERT + best[_USER])
        choices = 0
        for state, way in enumerate(ways):
            way["I"] = INSERT + best[_SAYS[state]]
            letter = min(c for c, cost in way.items() if cost == best[state])
            choices |= _LETTERS.index(letter) << (2 * state)
        least = min(best)
        return tuple(b - least for b in best), least, choices


def _pointers(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Back pointers of conversations whose rows come from the last to the first."""
    costs, none = Costs(), object()
    conv: object = none
    rows: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 6]
        names = [c.split()[0] for c in _POINTERS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        names = ("_conv", "turn", "role", "_h1", "_h2", "_said", "_fault")
        for this, turn, role, h1, h2, said, fault in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if conv is none or this != conv:
                if conv is not none:
                    rows.append((conv, *place, -block, bytes(choices[::-1]), *counts()))
                conv, block, choices, vector, paid, following = this, 1, bytearray(), _FINISH, 0, None
                seen, illegal, high, low, distinct = [0, 0, 0, 0], 0, None, None, 0

                def counts() -> tuple:
                    gaps = 0 if high is None else high - low + 1 - distinct
                    return gaps, seen[_BLANK], seen[_DUPLICATE], seen[_TRUNCATED], illegal, paid + vector[_NOTHING]

            if len(choices) == block_rows:
                rows.append((conv, *place, -block, bytes(choices[::-1]), *[None] * 6))
                block, choices = block + 1, bytearray()
            if turn is not None and turn != low:
                high, low, distinct = turn if high is None else high, turn, distinct + 1
            if following is not None and (said, following) not in ((_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)):
                illegal += 1
            following, place = said, (turn, role, h1, h2)
            seen[fault] += 1
            vector, least, choice = costs.step(vector, said, fault)
            paid += least
            choices.append(choice)
        if len(rows) > 10_000:
            yield batch_of(rows)
            rows = []
    if conv is not none:
        rows.append((conv, *place, -block, bytes(choices[::-1]), *counts()))
    if rows:
        yield batch_of(rows)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Edits in order, as tuples of ``_EDITS``, along back pointers that come before the rows they are of."""
    none = object()
    conv: object = none
    for batch in batches:
        names = ("_conv", "turn", "role", "text", "_kind", "choices", *_COUNTS)
        for this, turn, role, text, kind, choices, *stats in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if conv is none or this != conv:
                if conv is not none:
                    yield from _finish(conv, counts, n, state)
                conv, counts, n, state, queue, at = this, stats, 0, _NOTHING, bytearray(), 0
            if kind < 0:
                queue = queue[at:] + choices
                at = 0
                continue
            choice, at = queue[at], at + 1
            while (letter := _LETTERS[choice >> (2 * state) & 3]) == "I":
                state = _SAYS[state]
                yield conv, *counts, n, "I", None, _ROLE[state], ""
                n += 1
            if letter == "K":
                state = _said(role)
            elif letter == "R":
                state = _SAYS[state]
                role = _ROLE[state]
            yield conv, *counts, n, letter, turn, role, text
            n += 1
    if conv is not none:
        yield from _finish(conv, counts, n, state)


def _finish(conv: str | None, counts: list[int], n: int, state: int) -> Iterator[tuple]:
    while state in (_SYSTEM, _USER):
        state = _SAYS[state]
        yield conv, *counts, n, "I", None, _ROLE[state], ""
        n += 1


def _said(role: str) -> int:
    return {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}.get(role[:1], 0)


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), *[pa.int64()] * 7, pa.string(), pa.int64(), pa.string(), pa.string()]
    names = [c.split()[0] for c in _EDITS.split(", ")]
    rows, size = [], 0
    for row in _walk(batches):
        rows.append(row)
        size += len(row[-1]) + 64
        if size > 8_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def faults(turns: DataFrame) -> DataFrame:
    """Rows of conversations with their first fault, dealt by conversation.

    ``_conv`` is the conversation, ``_said`` the state that the role stands for
    and ``_fault`` 0 fine, 1 blank, 2 duplicate, 3 truncated.  Rows of one turn
    stand in the order of role and a hash of role and text, ``_h1, _h2``, which
    also finds equal rows; ``_nth`` numbers these.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(
        F.col("conv_id").cast("string").alias("_conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.xxhash64(role, text).alias("_h1"),
        F.xxhash64(F.lit("turn"), role, text).alias("_h2"),
        (~text.rlike(r"[^ \t-\r]")).alias("_blank"),
        (~text.rlike(r"[.!?][ \t-\r]*\z")).alias("_cut"),
    ).repartition("_conv")
    # The window needs the rows of a conversation together, as they are already.
    earlier = Window.partitionBy("_conv", "_h1", "_h2").orderBy(F.col("turn").asc_nulls_first())
    first = F.substring("role", 1, 1)
    rows = rows.withColumn("_nth", F.row_number().over(earlier))
    return rows.select(
        "_conv", "turn", "role", "_h1", "_h2", "_nth",
        F.when(first == "s", _SYSTEM).when(first == "u", _USER).when(first == "a", _ASSISTANT).otherwise(0).alias("_said"),
        F.when(F.col("_blank"), _BLANK).when(F.col("_nth") > 1, _DUPLICATE)
        .when(F.col("_cut"), _TRUNCATED).otherwise(_FINE).alias("_fault"),
    )


def repair(turns: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """The cheapest edits that make every conversation an optional system turn and user-assistant pairs, or nothing.

    ``turns`` has ``conv_id, turn, role, text``; a missing role or text counts as
    one space, and other columns are ignored.  Rows are taken by turn, those
    without one first, rows of one turn by role and a hash.  A row's first fault
    counts: blank, a duplicate of an earlier row's role and text, or
    truncated (its last character that is not white space ends no sentence).
    Edits, with their costs: ``K``eep 0, ``R``erole to user or assistant 3,
    ``D``elete 4, which blank and duplicate rows need, ``I``nsert an empty user
    or assistant turn 3; a truncated row that stays adds 3.  Of equally cheap
    edits the first in ASCII is taken.

    Returns a row per edit: ``conv_id``, the conversation's ``gaps`` (numbers
    missing between its turns), ``blank, duplicate, truncated``, ``illegal``
    (neighbouring roles out of order) and ``cost``; the number ``n`` and letter
    of the edit, ``turn`` (missing for ``I``), and ``role`` and ``text``
    after it (before it for ``D``).  A task has the edits of a conversation
    one after the other in order.  Rows without ``conv_id`` are one
    conversation; no rows, no edits.

    A conversation is one task's, as its edits depend on each other from end to
    end; a task holds back pointers of ``block_rows`` rows, whatever its length.
    """
    found = faults(turns)
    order = [F.col(c).desc() for c in ("role", "_h1", "_h2", "_nth")]
    backward = found.sortWithinPartitions("_conv", F.col("turn").desc_nulls_last(), *order)
    pointers = stage(backward.mapInArrow(lambda rows: _pointers(rows, block_rows), _POINTERS), "back-pointers")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(
        F.col("conv_id").cast("string").alias("_conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("_h1"), F.xxhash64(F.lit("turn"), role, text).alias("_h2"),
        F.lit(0).cast("long").alias("_kind"), text.alias("text"),
    )
    both = rows.unionByName(pointers, allowMissingColumns=True).repartition("_conv")
    forward = both.sortWithinPartitions("_conv", F.col("turn").asc_nulls_first(), "role", "_h1", "_h2", "_kind")
    edits = forward.mapInArrow(_edit_rows, _EDITS)
    return _named(edits, turns)


def _named(df: DataFrame, like: DataFrame) -> DataFrame:
    kind = like.schema["conv_id"].dataType if "conv_id" in like.columns else "string"
    return df.select(F.col("_conv").cast(kind).alias("conv_id"), *[c for c in df.columns if c != "_conv"])


def summarize(edits: DataFrame, ordered: bool = False) -> DataFrame:
    """A row per conversation of ``repair``: its counts, the letters of its edits and the repaired text.

    ``repaired_sha256`` is the digest of ``role:text`` of the turns that stay,
    joined by line feeds.  ``ordered`` says that a task has the edits of a
    conversation one after the other, as ``repair`` returns them.
    """
    if not ordered:
        edits = edits.repartition("conv_id").sortWithinPartitions("conv_id", "n")
    rows = edits.select(F.col("conv_id").cast("string").alias("_conv"), *[c for c in edits.columns if c != "conv_id"])
    return _named(rows.mapInArrow(_summaries, _SUMMARY), edits).withColumnRenamed("repaired", "repaired_sha256")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    none = object()
    conv: object = none
    rows: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
        names = [c.split()[0] for c in _SUMMARY.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        names = ("_conv", *_COUNTS, "edit", "role", "text")
        for this, *counts, edit, role, text in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if conv is none or this != conv:
                if conv is not none:
                    rows.append((conv, *stats, audit.decode(), digest.hexdigest()))
                conv, stats, audit, digest, joint = this, counts, bytearray(), hashlib.sha256(), ""
            audit += edit.encode()
            if edit != "D":
                digest.update(f"{joint}{role}:{text}".encode())
                joint = "\n"
        if len(rows) > 10_000:
            yield batch_of(rows)
            rows = []
    if conv is not none:
        rows.append((conv, *stats, audit.decode(), digest.hexdigest()))
    if rows:
        yield batch_of(rows)
