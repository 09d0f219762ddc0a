"""Conversation structure repair: iterative-deepening A* over the turns.

A conversation is sound when its role initials read ``(s?(ua)+)?`` and no turn
is blank, repeated or cut off. Every turn is kept (K, free), given the role that
fits (R, 1) or deleted (D, 2); empty turns may be inserted (I, 5) before any
turn and at the end; a cut-off turn that stays costs 5 more; blank and repeated
turns must go. The answer is the cheapest script, the least in ASCII order among
equals: a depth-first search tries D, I, K, R in this order under a bound that
rises by one; states (turn, place in the pattern) that failed are kept with the
budget they failed with; the first script accepted is the answer. The bound
starts at a lower estimate: two per faulty turn, and one per disjoint pair of
neighbouring sound turns that do not follow each other.

Plan: one shuffle by ranges of (conversation, turn, role and text), so a long
conversation is spread over tasks. A task cuts its sorted rows into pieces of at
most ``PIECE_ROWS`` turns. A conversation that is one piece inside one task is
answered there. The others go on as pieces: repeats are found by a partial
aggregate over (conversation, digest); the search gives each piece's cost from
every place to every place of the pattern; a pass from the last piece to the
first adds them to the cheapest cost to go; the search then gives each piece's
script from every place; a last pass in order picks the scripts and feeds the
repaired turns to the hash. Passes stream: a task holds one piece at a time
(and the scripts of one conversation, which are a cell of the result).

Results: null roles and texts read as one space, null conversations form one
conversation, null turns come first. Turns of equal number are ordered by role
and text. A conversation without turns is sound: zeros, an empty script, the
hash of the empty string. Very long texts travel in pieces of at most
``PIECE_BYTES`` or one text. An empty table gives an empty result; other columns
of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import materialize

PIECE_ROWS = 32
PIECE_BYTES = 8 << 20
SPACE = " \t\n\v\f\r"
INF = 1 << 60
# places in the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a
_END = (0, 10, 5, 0)                    # cost of the inserts that complete the pattern
_CLOSING = ("", "II", "I", "")
_WANTED = ("u", "u", "a", "u")          # initial that fits after each place
_AFTER = (2, 2, 3, 2)


# ---- search ----------------------------------------------------------------------
def _estimate(codes: str) -> list[int]:
    """Lower bound of the cost of the turns from each one on."""
    low = [0] * (len(codes) + 1)
    paired = -1                         # turns from here on are in a counted pair
    for i in range(len(codes) - 1, -1, -1):
        low[i] = low[i + 1]
        if codes[i] == "x" or codes[i].isupper():
            low[i] += 2
            continue
        j = i + 1
        while j < len(codes) and codes[j] == "x":
            j += 1
        if j < len(codes) and codes[j].islower() and (paired < 0 or j < paired) \
                and codes[i] + codes[j] not in ("su", "ua", "au"):
            low[i] += 1
            paired = i
    return low


@lru_cache(maxsize=1 << 16)
def search(codes: str, start: int, goal: tuple[int, ...]) -> tuple[int, str, int] | None:
    """Cheapest script, least in ASCII order, that takes the turns from place ``start`` on.

    ``codes``: per turn x (must go) or its initial s, u, a, o (other), upper case
    if cut off. ``goal``: what ending at each place costs. No inserts after the
    last turn. Gives (cost, script, place), or None where no end can be reached.
    """
    n = len(codes)
    reach = [goal[p] for p in range(4) if goal[p] < INF and _reachable(codes, start, p)]
    if not reach:
        return None
    low = _estimate(codes)
    least = min(reach)
    failed: dict[int, int] = {}
    bound = low[0] + least
    while True:
        script: list[str] = []
        stack = [[0, start, 0, 0]]      # turn, place, spent, edits tried
        while stack:
            top = stack[-1]
            i, place, spent, tried = top
            node = 4 * i + place
            if tried == 0:
                if i == n:
                    if spent + goal[place] <= bound:
                        return bound, "".join(script), place
                    tried = 4
                elif spent + low[i] + least > bound or failed.get(node, -1) >= bound - spent:
                    tried = 4
            if tried >= 4:
                if i < n:
                    failed[node] = max(failed.get(node, -1), bound - spent)
                stack.pop()
                if script:
                    script.pop()
                continue
            top[3] = tried + 1
            code = codes[i]
            if tried == 0:
                script.append("D")
                stack.append([i + 1, place, spent + 2, 0])
            elif tried == 1:
                script.append("I")
                stack.append([i, _AFTER[place], spent + 5, 0])
            elif code != "x":
                initial, extra = code.lower(), 5 if code.isupper() else 0
                if tried == 3:
                    script.append("R")
                    stack.append([i + 1, _AFTER[place], spent + 1 + extra, 0])
                elif initial == _WANTED[place] or (initial == "s" and place == 0):
                    script.append("K")
                    stack.append([i + 1, 1 if initial == "s" else _AFTER[place], spent + extra, 0])
        bound += 1


def _reachable(codes: str, start: int, end: int) -> bool:
    if end < 2:
        return start == end or (start == 0 and end == 1 and "s" in codes.lower())
    return len(codes) > 0 or start == end


def _costs(codes: str) -> list[int]:
    """Cost from each place (row) to each place."""
    out = []
    for start in range(4):
        for end in range(4):
            got = search(codes, start, tuple(0 if p == end else INF for p in range(4)))
            out.append(got[0] if got else INF)
    return out


# ---- one conversation ------------------------------------------------------------
def _fault(text: str) -> str:
    body = text.rstrip(SPACE)
    return "b" if not body else "." if body[-1] in ".!?" else "t"


def _code(role: str, fault: str) -> str:
    if fault in "bd":
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == "t" else initial


def _codes(roles: list[str], faults: str) -> str:
    return "".join(map(_code, roles, faults))


class _Report:
    """What is said of one conversation, from its pieces in order."""

    def __init__(self, conv):
        self.conv = conv
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.distinct = 0
        self.low = self.high = self.last = None
        self.place, self.lines, self.audit, self.hash = 0, 0, [], hashlib.sha256()

    def add(self, roles, texts, faults, turns, script, place, cost):
        low, high, distinct = turns
        if low is not None:
            self.distinct += distinct - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high
        self.blank += faults.count("b")
        self.duplicate += faults.count("d")
        self.truncated += faults.count("t")
        for role in roles:
            if self.last is not None:
                self.illegal += self.last + role[:1] not in ("su", "ua", "au")
            self.last = role[:1]
        at = 0
        for edit in script:
            role, text = ("", "") if edit == "I" else (roles[at], texts[at])
            at += edit != "I"
            if edit == "D":
                continue
            if edit == "K":
                self.place = 1 if role[:1] == "s" else _AFTER[self.place]
            else:
                self.place = _AFTER[self.place]
                role = "assistant" if self.place == 3 else "user"
            self._line(role, text)
        assert self.place == place
        self.audit.append(script)
        self.cost += cost

    def _line(self, role, text):
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def row(self) -> dict:
        closing = _CLOSING[self.place]
        self.cost += _END[self.place]
        for _ in closing:
            self.place = _AFTER[self.place]
            self._line("assistant" if self.place == 3 else "user", "")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "cost": self.cost,
                "audit": "".join(self.audit) + closing, "repaired_sha256": self.hash.hexdigest()}


_RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
           ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, " \
       "repaired_sha256 string"


class _Piece:
    def __init__(self, conv):
        self.conv, self.roles, self.texts, self.faults, self.size = conv, [], [], [], 0
        self.low = self.high = None
        self.distinct = 0

    def add(self, turn, role, text):
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(_fault(text))
        self.size += len(text)
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn

    def full(self) -> bool:
        return len(self.roles) >= PIECE_ROWS or self.size >= PIECE_BYTES

    def answer(self) -> dict:
        """The result of a conversation that is this piece."""
        seen, faults = set(), []
        for role, text, fault in zip(self.roles, self.texts, self.faults):
            faults.append("d" if fault != "b" and (role, text) in seen else fault)
            seen.add((role, text))
        faults = "".join(faults)
        _, script, place = search(_codes(self.roles, faults), 0, _END)
        report = _Report(self.conv)
        cost = _spent(self.roles, faults, script)
        report.add(self.roles, self.texts, faults, (self.low, self.high, self.distinct), script, place, cost)
        return report.row()


def _spent(roles, faults, script) -> int:
    cost, at = 0, 0
    for edit in script:
        cost += {"D": 2, "I": 5, "K": 0, "R": 1}[edit]
        if edit != "I":
            cost += 5 * (edit != "D" and faults[at] == "t")
            at += 1
    return cost


# ---- Spark -----------------------------------------------------------------------
def damage(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Test damage by a checksum of conversation and turn: of twenty turns one each is dropped
    (``gone``), emptied, robbed of its sentence ends, repeated, and given to the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said(conv_id), F.lit(":"), said(turn)).cast("binary")) % 20
    rows = df.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said(text), "[.!?]", "")).otherwise(said(text))
         .alias("text"),
        (kind == 0).alias("gone"), F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("times"))
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           gone: str | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest script of edits and the digest of the
    repaired ``role:text`` lines. Rows marked ``gone`` only name their conversation."""
    kind = df.schema[conv_id].dataType.simpleString()
    rows = df.select(F.col(conv_id).alias("c"), F.col(turn).cast("long").alias("t"),
                     F.coalesce(F.col(role), F.lit(" ")).alias("r"), F.coalesce(F.col(text), F.lit(" ")).alias("x"),
                     (F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).alias("gone"))
    tie = F.concat("r", F.lit("\x00"), "x")
    dealt = (rows.repartitionByRange(F.col("c"), F.col("t"), F.left(tie, F.lit(64)))
                 .sortWithinPartitions(F.col("c"), F.col("t"), tie))
    cut = materialize(dealt.mapInArrow(_cut, f"conv_id {kind}, whole boolean, {_DDL}, s long, roles array<string>, "
                                             "texts array<string>, faults string, low long, high long, "
                                             "distinct long"), "turns")
    names = ["conv_id", *[n for n, _ in _RESULT]]
    whole = cut.filter("whole").select(*names)
    return whole.unionByName(_joined(cut.filter("not whole"), kind).select(*names))


def _cut(batches):
    """Sorted rows of a task as answered conversations and pieces of the others."""
    base = TaskContext.get().partitionId() << 33
    made, piece, number, first = [], None, 0, True
    kind = None

    def close(piece, whole):
        nonlocal number
        number += 1
        out = {"conv_id": piece.conv, "whole": whole}
        if whole:
            return out | piece.answer()
        return out | {"s": base + number, "roles": piece.roles, "texts": piece.texts,
                      "faults": "".join(piece.faults), "low": piece.low, "high": piece.high,
                      "distinct": piece.distinct}

    def batch():
        schema = pa.schema([("conv_id", kind), ("whole", pa.bool_()), *_RESULT, ("s", pa.int64()),
                            ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                            ("faults", pa.string()), ("low", pa.int64()), ("high", pa.int64()),
                            ("distinct", pa.int64())])
        return pa.RecordBatch.from_pylist(made, schema=schema)

    begun = False               # the conversation has an earlier piece, or may have one in another task
    for part in batches:
        kind = part.schema.field(0).type
        for at in range(0, part.num_rows, 1000):
            some = part.slice(at, 1000).to_pydict()
            for c, t, r, x, gone in zip(*(some[k] for k in ("c", "t", "r", "x", "gone"))):
                if piece is None or piece.conv != c:
                    if piece is not None:
                        made.append(close(piece, not begun))
                        begun = False
                    else:
                        begun = True
                    piece = _Piece(c)
                elif piece.full():
                    made.append(close(piece, False))
                    piece, begun = _Piece(c), True
                if not gone:
                    piece.add(t, r, x)
                if len(made) >= 500 or piece.size >= PIECE_BYTES and made:
                    yield batch()
                    made = []
    if piece is not None:
        made.append(close(piece, False))
        yield batch()


def _joined(pieces: DataFrame, kind: str) -> DataFrame:
    """Results of the conversations that are several pieces."""
    key = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    pieces = pieces.withColumn("k", key)
    turns = pieces.select("k", "s", F.posexplode(F.zip_with("roles", "texts", lambda r, x: F.sha2(
        F.concat(F.length(r).cast("string"), F.lit(":"), r, x).cast("binary"), 256))).alias("i", "digest"))
    firsts = (turns.groupBy("k", "digest").agg(F.min(F.struct("s", "i")).alias("first"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").drop("n"))
    again = (turns.join(firsts, ["k", "digest"]).filter(F.struct("s", "i") != F.col("first"))
                  .groupBy("s").agg(F.collect_list("i").alias("again")))
    light = pieces.select("k", "s", "faults", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials"))
    coded = materialize(light.join(again, "s", "left").mapInArrow(_piece_costs, _CODED), "pieces")
    goals = (coded.repartition("k").sortWithinPartitions("k", F.desc("s")).mapInArrow(_cost_to_go, _GOALS)
                  .repartition("s").mapInArrow(_scripts, _SCRIPTS))
    ordered = (pieces.drop("faults", *[n for n, _ in _RESULT]).join(goals, "s").repartition("k")
                     .sortWithinPartitions("k", "s"))
    return ordered.mapInArrow(_reports, f"conv_id {kind}, {_DDL}")


_CODED = "k string, s long, faults string, codes string, costs array<long>"
_GOALS = "s long, faults string, codes string, goal array<long>"
_SCRIPTS = "s long, faults string, scripts array<string>, places array<int>, costs array<long>"
_ARROW = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()),
          "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def _rows(batches, ddl, make):
    schema = pa.schema([(n, _ARROW[t]) for n, t in (f.split(" ") for f in ddl.split(", "))])
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield pa.RecordBatch.from_pylist([make(row) for row in batch.slice(at, 1000).to_pylist()], schema=schema)


def _piece_costs(batches):
    def make(row):
        repeated = set(row["again"] or ())
        faults = "".join("d" if i in repeated and f != "b" else f for i, f in enumerate(row["faults"]))
        codes = _codes(row["initials"], faults)
        return {"k": row["k"], "s": row["s"], "faults": faults, "codes": codes, "costs": _costs(codes)}
    yield from _rows(batches, _CODED, make)


def _cost_to_go(batches):
    """Pieces of a conversation from the last to the first: what each place after a piece costs."""
    key, goal = None, None

    def make(row):
        nonlocal key, goal
        if row["k"] != key:
            key, goal = row["k"], list(_END)
        out = {"s": row["s"], "faults": row["faults"], "codes": row["codes"], "goal": goal}
        c = row["costs"]
        goal = [min(min(c[4 * a + b] + goal[b] for b in range(4)), INF) for a in range(4)]
        return out
    yield from _rows(batches, _GOALS, make)


def _scripts(batches):
    def make(row):
        found = [search(row["codes"], place, tuple(row["goal"])) for place in range(4)]
        scripts = [f[1] if f else None for f in found]
        return {"s": row["s"], "faults": row["faults"], "scripts": scripts,
                "places": [f[2] if f else -1 for f in found],
                "costs": [f[0] - row["goal"][f[2]] if f else -1 for f in found]}
    yield from _rows(batches, _SCRIPTS, make)


def _reports(batches):
    report, key, kind, made = None, None, None, []

    def batch():
        return pa.RecordBatch.from_pylist(made, schema=pa.schema([("conv_id", kind), *_RESULT]))

    for part in batches:
        kind = part.schema.field("conv_id").type
        for at in range(part.num_rows):
            row = part.slice(at, 1).to_pylist()[0]
            if report is None or row["k"] != key:
                if report is not None:
                    made.append(report.row())
                report, key = _Report(row["conv_id"]), row["k"]
            place = report.place
            report.add(row["roles"], row["texts"], row["faults"], (row["low"], row["high"], row["distinct"]),
                       row["scripts"][place], row["places"][place], row["costs"][place])
            if len(made) >= 500:
                yield batch()
                made = []
    if report is not None:
        made.append(report.row())
        yield batch()
