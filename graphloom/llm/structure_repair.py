"""Conversation structure repair: cost DP, then prefix-doubling path ranking.

The roles of a conversation should read ``(s?(ua)+)?``: nothing, or an optional
system turn and then user and assistant in turn.  Rows may be kept, given
another role or deleted, and empty turns inserted, each at a cost.

1. A backward DP over (rows done, state of the pattern) gives every node the
   least cost of the rest; the arcs on some cheapest way are the optimal arcs.
2. Every arc is one letter of the audit.  A node's arcs carry different letters,
   so the least audit of a node starts with its least letter, and one pointer a
   node is enough.  Pointers are doubled; nodes are ranked by their audits of 1,
   2, 4, ... letters, each rank from two ranks of half the length.
3. Conversations whose start nodes share the last rank have one audit, which is
   read once, every letter by its own jump through the doubled pointers.

The rows pass twice: first as one small code a row, for the DP, then with their
texts, which are hashed as they come by.  No text is held.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.arrow import map_arrow
from graphloom.llm.prefix_trie import turn_digest

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; keeping is free
ROWS_AT_ONCE = 50_000  # rows of whole conversations solved together
# pattern states: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 may end
_TURN = np.array([2, 2, 3, 2])  # state after the turn that may come next, u or a
_KEEP = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])  # by initial s, u, a, other
_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_FAR = 1 << 40
_INITIAL, _GONE, _CUT = 3, 4, 8  # a row's code: initial, must be deleted, truncated


def cheapest(codes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Least cost of the rest for every node (boundary, state).  Conversation j has
    the rows ``first[j]`` on and the boundaries ``first[j] + j`` on, one more."""
    cost = np.zeros((len(codes) + len(length), 4), np.int64)
    order = np.argsort(-length, kind="stable")
    falling = -length[order]
    start = (first + np.arange(len(first)))[order]
    twice = _TURN[_TURN]
    for back in range(int(length.max(initial=0)) + 1):
        live = int(np.searchsorted(falling, -back, side="right"))  # conversations with so many rows
        at = start[:live] - falling[:live] - back
        if back == 0:
            here = np.tile(np.array([0, _FAR, _FAR, 0]), (live, 1))
        else:
            rest = cost[at + 1]
            code = codes[first[order[:live]] - falling[:live] - back]
            here = DELETE + rest
            stays = (code & _GONE) == 0
            extra = np.where((code & _CUT) != 0, TRUNCATED, 0)[:, None]
            target = _KEEP[code & _INITIAL]
            kept = np.where(target >= 0, np.take_along_axis(rest, np.maximum(target, 0), 1), _FAR) + extra
            turned = REROLE + rest[:, _TURN] + extra
            here = np.where(stays[:, None], np.minimum(here, np.minimum(kept, turned)), here)
        # one or two turns inserted before the next row
        cost[at] = np.minimum(here, np.minimum(INSERT + here[:, _TURN], 2 * INSERT + here[:, twice]))
    return cost


def least_arcs(codes: np.ndarray, first: np.ndarray, length: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letter, node it leads to) of every node's optimal arc with the least letter;
    the end has letter 0 and leads to itself.  Node = boundary * 4 + state."""
    n = len(cost)
    last = np.zeros(n, bool)
    last[first + np.arange(len(first)) + length] = True
    code = np.full(n, _GONE | 3)
    code[~last] = codes
    rest = np.concatenate((cost[1:], np.full((1, 4), _FAR)))
    rest[last] = _FAR
    stays = ((code & _GONE) == 0)[:, None]
    extra = np.where((code & _CUT) != 0, TRUNCATED, 0)[:, None]
    target = _KEEP[code & _INITIAL]
    to_keep = np.maximum(target, 0)
    state = np.broadcast_to(np.arange(4), (n, 4))
    turn = np.broadcast_to(_TURN, (n, 4))
    ways = [  # in the order of their letters
        ("D", ~last[:, None], DELETE + rest, 1, state),
        ("I", True, INSERT + cost[:, _TURN], 0, turn),
        ("K", stays & (target >= 0), np.take_along_axis(rest, to_keep, 1) + extra, 1, to_keep),
        ("R", stays, REROLE + rest[:, _TURN] + extra, 1, turn),
    ]
    letter = np.zeros((n, 4), np.uint8)
    leads = np.arange(4 * n).reshape(n, 4)
    for name, allowed, total, step, state_after in ways:
        take = allowed & (total == cost) & (letter == 0)
        letter[take] = ord(name)
        place = (np.arange(n)[:, None] + step) * 4 + state_after
        leads[take] = place[take]
    return letter.ravel(), leads.ravel()


def audits(codes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """(cost, audit) of every conversation: the cheapest edits, ASCII-least among them."""
    first = np.cumsum(length) - length
    cost = cheapest(codes, first, length)
    letter, leads = least_arcs(codes, first, length, cost)
    start = (first + np.arange(len(first))) * 4
    jumps = [leads.astype(np.int32)]
    rank = letter.astype(np.int64)  # of the first 1, 2, 4, ... letters
    made = (letter > 0).astype(np.int64)  # letters so far
    while letter[jumps[-1][start]].any():
        j = jumps[-1]
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[j], return_inverse=True)
        made = made + made[j]
        jumps.append(j[j])
    _, one, same = np.unique(rank[start], return_index=True, return_inverse=True)
    size = made[start[one]]
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    node = np.repeat(start[one], size)
    for k, j in enumerate(jumps):
        node = np.where((step >> k) & 1, j[node], node)
    text = letter[node].tobytes().decode("ascii")
    ends = np.cumsum(size).tolist()
    distinct = [text[a:z] for a, z in zip([0, *ends], ends)]
    return cost.ravel()[start], [distinct[i] for i in same.tolist()]


# damage ----------------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by crc32(conv_id:turn) % 20: 0 drops a
    row (``lost``), 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it
    (``copy`` 1), 4 sets its role to user.  Nulls count as one space (a null
    ``turn`` stays null and a null ``conv_id`` is a conversation of its own).
    ``tie`` orders the rows of one turn."""
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        turn_digest(role, text).alias("tie"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("lost"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.select("conv_id", "turn", "tie", "role", "text", "lost", F.explode("copies").alias("copy"))


def whole(conversations: DataFrame) -> DataFrame:
    """``conversations`` as :func:`damaged` returns them, without any damage."""
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_digest(role, text).alias("tie"),
        role.alias("role"), text.alias("text"), F.lit(False).alias("lost"), F.lit(0).alias("copy"),
    )


# first pass: codes ------------------------------------------------------------------
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_AUDIT = T.StructType(
    [T.StructField("conv_id", T.LongType())] + [T.StructField(c, T.LongType()) for c in _COUNTS] + [T.StructField("audit", T.StringType())]
)
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au


class _Conversation:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, initial: int, blank: bool, cut: bool, digest: bytes) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        code = initial
        if blank:
            self.blank += 1
            code |= _GONE
        elif digest in self.seen:
            self.duplicate += 1
            code |= _GONE
        elif cut:
            self.truncated += 1
            code |= _CUT
        self.seen.add(digest)
        self.codes.append(code)


def _solved(done: list[_Conversation]) -> pa.RecordBatch:
    codes = np.frombuffer(b"".join(bytes(c.codes) for c in done), np.uint8).astype(np.int64)
    length = np.array([len(c.codes) for c in done], np.int64)
    cost, text = audits(codes, length)
    illegal = np.zeros(len(done) + 1, np.int64)
    if len(codes) > 1:
        owner = np.repeat(np.arange(len(done)), length)
        initial = codes & _INITIAL
        wrong = (owner[1:] == owner[:-1]) & ~_LEGAL[initial[:-1], initial[1:]]
        illegal += np.bincount(owner[1:][wrong], minlength=len(done) + 1)
    gaps = [c.high - c.low + 1 - c.turns if c.turns else 0 for c in done]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([c.conv_id for c in done], pa.int64()),
            pa.array(gaps, pa.int64()),
            *(pa.array([getattr(c, k) for c in done], pa.int64()) for k in ("blank", "duplicate", "truncated")),
            pa.array(illegal[: len(done)]),
            pa.array(cost),
            pa.array(text, pa.string()),
        ],
        names=_AUDIT.names,
    )


def _audit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[_Conversation] = []
    rows = 0
    current: _Conversation | None = None
    for b in batches:
        for conv_id, turn, lost, initial, blank, cut, digest in zip(*(b.column(c).to_pylist() for c in _CODE)):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    current.seen.clear()
                    done.append(current)
                    rows += len(current.codes) + 1
                    if rows > ROWS_AT_ONCE:
                        yield _solved(done)
                        done, rows = [], 0
                current = _Conversation(conv_id)
            if not lost:
                current.add(turn, initial, blank, cut, digest)
    if current is not None:
        yield _solved([*done, current])


_CODE = ["conv_id", "turn", "lost", "initial", "blank", "cut", "digest"]


def _ordered(df: DataFrame, *front: str) -> DataFrame:
    """One conversation in one task, its rows by turn (null first)."""
    by = [F.col(c).asc_nulls_first() for c in ("conv_id", *front, "turn", "tie", "copy")]
    return df.repartition("conv_id").sortWithinPartitions(*by)


def audit_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation."""
    initial = F.substring("role", 1, 1)
    kinds = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    visible = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))  # up to the last visible character
    coded = rows.select(
        "conv_id", "turn", "tie", "copy", "lost",
        kinds.alias("initial"),
        (F.length(visible) == 0).alias("blank"),
        (~F.substring(visible, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.unhex(turn_digest(F.col("role"), F.col("text"))).alias("digest"),
    )
    return map_arrow(_ordered(coded).select(*_CODE), _audit_task, _AUDIT)


# second pass: texts -----------------------------------------------------------------
_REPAIRED = T.StructType([*_AUDIT.fields, T.StructField("repaired_sha256", T.StringType())])


class Repair:
    """Follows an audit over the rows of a conversation and yields its repaired turns."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.turns = audit, 0, 0, 0

    def _made(self, role: str, text: str, state: int) -> tuple[str, str]:
        self.state, self.turns = state, self.turns + 1
        return role, text

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self._made(_ROLE[self.state], "", int(_TURN[self.state]))

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            yield self._made(role, text, 1 if role[0] == "s" else int(_TURN[self.state]))
        elif letter == "R":
            yield self._made(_ROLE[self.state], text, int(_TURN[self.state]))


def _hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head: list | None = None
    repair, state = Repair(""), hashlib.sha256()

    def put(turns: Iterator[tuple[str, str]]) -> None:
        for role, text in turns:
            state.update(f"{chr(10) if repair.turns > 1 else ''}{role}:{text}".encode())

    def finish() -> list:
        put(repair.inserted())
        return [*head, state.hexdigest()]

    def out(rows: list[list]) -> pa.RecordBatch:
        types = [pa.int64()] * (len(_COUNTS) + 1) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_REPAIRED.names)

    for b in batches:
        rows = []
        columns = [b.column(c).to_pylist() for c in ("body", "role", "text", *_AUDIT.names)]
        for body, role, text, *audit in zip(*columns):
            if body:
                put(repair.row(role, text))
                continue
            if head is not None:
                rows.append(finish())
            head, repair, state = audit, Repair(audit[-1]), hashlib.sha256()
        if rows:
            yield out(rows)
    if head is not None:
        yield out([finish()])


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The cheapest repair of every conversation in ``rows`` (columns as
    :func:`damaged` or :func:`whole` return them).

    One row per ``conv_id``: ``gaps`` (turn numbers missing between the smallest and
    the largest), ``blank``, ``duplicate`` and ``truncated`` rows (a row's first
    fault counts), ``illegal`` neighbouring roles, ``cost``, ``audit`` (K keep,
    R rerole, D delete, I insert, the ASCII-least of the cheapest) and
    ``repaired_sha256`` (the repaired turns ``role:text``, newline-joined).

    A conversation whose rows are all lost gets zeros, an empty audit and the hash
    of nothing; an empty table gives no rows; rows of one turn are ordered by a
    digest of role and text, equal rows are duplicates; other columns are ignored.
    Of a conversation, a task holds one byte a row, the digests of its distinct
    rows and its audit, which is one value of the result.
    """
    found = audit_rows(rows)
    nothing = {c: F.lit(None).cast(f.dataType) for c, f in zip(_AUDIT.names[1:], _AUDIT.fields[1:])}
    bodies = rows.where(~F.col("lost")).select(
        "conv_id", F.lit(True).alias("body"), "turn", "tie", "copy", "role", "text", *[v.alias(c) for c, v in nothing.items()]
    )
    heads = found.select(
        "conv_id", F.lit(False).alias("body"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("tie"), F.lit(0).alias("copy"),
        F.lit("").alias("role"), F.lit("").alias("text"), *_AUDIT.names[1:],
    )
    return map_arrow(_ordered(heads.unionByName(bodies), "body"), _hash_task, _REPAIRED)
