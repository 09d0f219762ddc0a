"""Conversation repair against a search over all scripts (uniform cost over strings)."""

import hashlib
import heapq
import random
import zlib

import pytest

from encore.llm import repair
from encore.llm.queries import op12_repair

SPACE = " \t\n\v\f\r"


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def _best(turns):
    """Cheapest script, ASCII-least, by uniform-cost search over (cost, script)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while heap:
        cost, script, at, last, lines = heapq.heappop(heap)
        if (at, last) in seen:
            continue
        seen.add((at, last))
        if at == len(turns) and last in ("", "a"):
            return cost, script, lines
        def step(c, edit, role, text, on):
            initial = role[:1]
            if not ((initial == "s" and last == "") or (initial == "u" and last in ("", "s", "a"))
                    or (initial == "a" and last == "u")):
                return
            heapq.heappush(heap, (cost + c, script + edit, at + on, initial, (*lines, f"{role}:{text}")))
        for role in ("user", "assistant"):
            step(5, "I", role, "", 0)
        if at < len(turns):
            role, text, fault = turns[at]
            heapq.heappush(heap, (cost + 2, script + "D", at + 1, last, lines))
            if fault not in "bd":
                extra = 5 if fault == "t" else 0
                step(extra, "K", role, text, 1)
                for new in ("user", "assistant"):
                    step(1 + extra, "R", new, text, 1)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in _damaged(rows) if r[0] == conv),
                       key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faulty = set(), []
        for _, _, role, text in turns:
            body = text.strip(SPACE)
            fault = ("b" if not body else "d" if (role, text) in seen else "." if body[-1] in ".!?" else "t")
            seen.add((role, text))
            faulty.append((role, text, fault))
        numbers = [t[1] for t in turns if t[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [t[2][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        count = lambda f: sum(x[2] == f for x in faulty)
        cost, script, lines = _best(faulty)
        out[conv] = (gaps, count("b"), count("d"), count("t"), illegal, cost, script,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _rows(seed, convs=40, most=9):
    rnd = random.Random(seed)
    rows = []
    for c in [None, *range(convs)]:
        for t in range(rnd.randrange(1, most)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", None, "tool", "ünder", ""])
            text = rnd.choice(["Yes.", "No!", "half a", " ", "", None, "Yes.", "wait?\n\t", " ", f"t{t}."])
            rows.append((c, rnd.choice([t, t, t, t + 2, None, -t]), role, text))
    return rows


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _got(df):
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}
    return out


def _table(spark, rows):
    # extra columns with names that the operator uses itself
    return spark.createDataFrame([(*r, "x", 7) for r in rows],
                                 "conv_id long, turn long, role string, text string, s string, k int")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_search_over_scripts(spark, seed):
    rows = _rows(seed)
    got = _got(repair.repair(repair.damage(_table(spark, rows).repartition(5)), gone="gone"))
    assert got == brute(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_pieces_equal_whole_conversations(spark, size):
    """Conversations in many pieces, over many tasks."""
    rows = _rows(4, convs=12, most=30)
    pieces = spark.createDataFrame([r for r in _cut_rows(rows, size)], "conv_id long, whole boolean, gaps long, "
                                   "blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
                                   "repaired_sha256 string, s long, roles array<string>, texts array<string>, "
                                   "faults string, low long, high long, distinct long")
    assert _got(repair._joined(pieces, "bigint")) == brute(rows)


def _cut_rows(rows, size):
    number = 0
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in _damaged(rows) if r[0] == conv),
                       key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        for at in range(0, max(len(turns), 1), size):
            piece = repair._Piece(conv)
            for _, turn, role, text in turns[at:at + size]:
                piece.add(turn, role, text)
            number += 1
            yield (conv, False, *[None] * 8, number, piece.roles, piece.texts, "".join(piece.faults), piece.low,
                   piece.high, piece.distinct)


def test_long_conversation_long_text_and_empty_table(spark):
    rnd = random.Random(6)
    rows = [(1, t, rnd.choice(["user", "assistant"]), f"turn {t}" + rnd.choice([".", ".", ""])) for t in range(300)]
    rows += [(2, 0, "user", "w " * 500_000 + "."), (2, 1, "assistant", "ok.")]
    assert _got(repair.repair(repair.damage(_table(spark, rows)), gone="gone")) == brute(rows)
    assert repair.repair(repair.damage(_table(spark, rows).limit(0)), gone="gone").count() == 0


def test_search_is_the_least_in_ascii_order():
    for codes in ("uu", "ua", "aa", "suua", "sx", "Uax", "oa", "au", "uaU", "ssu"):
        cost, script, place = repair.search(codes, 0, (0, 10, 5, 0))
        turns = [("system" if c.lower() == "s" else "user" if c.lower() == "u" else "assistant" if c.lower() == "a"
                  else "tool", str(i), "b" if c == "x" else "t" if c.isupper() else ".") for i, c in enumerate(codes)]
        want = _best(turns)
        assert (cost, script + ("", "II", "I", "")[place]) == want[:2], codes


def test_query_covers_every_conversation(spark):
    root = "/root/testdata/sf0.001"
    talks = spark.read.parquet(f"{root}/conversations.parquet")
    rows = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    assert _got(op12_repair(spark, root)) == brute(rows)
