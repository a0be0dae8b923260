"""Conversation repair against a search over all edit strings, on random and odd conversations."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from vitalgrid.llm import conversations as cv
from vitalgrid.llm.common import table
from vitalgrid.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, audit string, copies string"


def cheapest(codes: str) -> tuple[int, str]:
    """Cheapest (cost, audit) over all edit strings, by increasing (cost, audit)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if i == len(codes) and last in ("", "a"):
            return cost, audit
        if (i, last) in seen:
            continue
        seen.add((i, last))
        need = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, need))
        if i < len(codes):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            c = codes[i]
            broken = c.isupper()
            if c != "x":
                if c.lower() == need or (c.lower() == "s" and last == ""):
                    heapq.heappush(heap, (cost + broken, audit + "K", i + 1, c.lower()))
                if c.lower() != need:
                    heapq.heappush(heap, (cost + 2 + broken, audit + "R", i + 1, need))
    raise AssertionError


def brute(rows) -> dict:
    """The result stated row by row; rows are (conv_id, turn, role, text, copies)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text, copies in rows:
            if _ == conv:
                role, text = " " if role is None else role, " " if text is None else text
                digest = hashlib.sha256(f"{len(role)}\n{role}\n{text}".encode()).digest()
                turns += [(turn is not None, turn or 0, role, digest, text)] * copies
        turns.sort()
        seen, codes, n = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, _, text in turns:
            end = text.rstrip(SPACE)
            if not end:
                n["blank"] += 1
                codes += "x"
            elif (role, text) in seen:
                n["duplicate"] += 1
                codes += "x"
            else:
                broken = end[-1] not in ".!?"
                n["truncated"] += broken
                c = role[:1] if role[:1] in ("s", "u", "a") else "o"
                codes += c.upper() if broken else c
            seen.add((role, text))
        cost, audit = cheapest(codes)
        known = sorted({t[1] for t in turns if t[0]})
        gaps = known[-1] - known[0] + 1 - len(known) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        said, rest = [], iter(turns)
        for edit in audit:
            need = "assistant" if said and said[-1][0][0] == "u" else "user"
            if edit == "I":
                said.append((need, ""))
                continue
            t = next(rest)
            if edit != "D":
                said.append((t[2] if edit == "K" else need, t[4]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def results(df) -> dict:
    found = df.select("conv_id", *COLUMNS).collect()
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: tuple(r[1:]) for r in found}


def test_blocks_give_the_cheapest_least_audit():
    draw = random.Random(5)
    for _ in range(400):
        codes = "".join(draw.choice("uuuaaasUAxo") for _ in range(draw.randint(0, 9)))
        ends = {end: found for end, *found in cv.block_repairs(codes, cv.START)}
        assert min(tuple(ends[p]) for p in cv.COMPLETE if p in ends) == cheapest(codes), codes


def test_bands_lose_nothing():
    draw = random.Random(6)
    for _ in range(200):
        codes = "".join(draw.choice("uaUAsxo") for _ in range(draw.randint(0, 8)))
        target = cv.grammar_string(cv.START, draw.randint(0, 9), draw.random() < 0.3)
        wide = cv.aligned(codes, target, 10**6)
        if wide is not None and wide[0] < 10**6:
            assert cv.aligned(codes, target, wide[0]) == wide
            assert cv.aligned(codes, target, wide[0] - 1) is None


@pytest.mark.parametrize("length", [63, 64, 65, 200, 400])
def test_long_conversations_in_blocks(spark, length):
    draw = random.Random(length)
    rows = []
    for turn in range(length):
        role = draw.choice(["user", "assistant"]) if turn % 7 == 0 else ("user", "assistant")[turn % 2]
        text = draw.choice(["", "open", f"said {turn}.", f"said {turn}!", f"asked {turn}?", "again."])
        rows.append((1, turn, role, text, draw.choice([0, 1, 1, 1, 1, 2])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    assert results(cv.repair_conversations(df, copies="n")) == brute(rows)


def test_random_and_odd_rows(spark):
    draw = random.Random(9)
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(draw.randint(1, 9)):
            t = draw.choice([None, turn, turn, turn, turn, turn + 3, 2])
            role = draw.choice(["user", "assistant", "user", "assistant", "system", None, "", "human", "usher"])
            text = draw.choice([None, "", " \t\n", "Hi.", "Hi", "Well?\n", "no end", f"turn {turn}.", "é" * 900 + "."])
            rows.append((conv, t, role, text, draw.choice([0, 1, 1, 1, 2, 3])))
    rows += rows[:40]  # repeated rows
    rows += [(500, i, "user", "x." if i else " ", 0) for i in range(3)]  # nothing left
    data = [(*r[:4], "clash", str(r[4])) for r in rows]
    df = spark.createDataFrame(data, SCHEMA)
    got = results(cv.repair_conversations(df, copies="copies"))
    assert got == brute(rows)
    assert got[500] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_one_conversation_holds_all_rows(spark):
    rows = [(7, i // 2, ("user", "assistant")[i % 2], f"line {i % 900}.", 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int").repartition(5)
    assert results(cv.repair_conversations(df)) == brute(rows)


def test_repaired_turns_follow_the_grammar(spark):
    df = spark.createDataFrame(
        [(1, 0, "system", "Be kind.", None, None), (1, 1, "assistant", "Hello.", None, None), (1, 2, "user", "Hm.", None, None)], SCHEMA
    )
    audits = cv.audit_conversations(df)
    turns = cv.repaired_turns(df, audits).orderBy("position").collect()
    assert [(r.edit, r.role, r.text) for r in turns] == [
        ("K", "system", "Be kind."), ("I", "user", ""), ("K", "assistant", "Hello."), ("K", "user", "Hm."), ("I", "assistant", ""),
    ]


def test_empty_table(spark):
    assert cv.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    damaged = []
    for r in table(spark, sf, "conversations").collect():
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        role = "user" if fault == 4 else r.role
        text = "" if fault == 1 else r.text.translate(str.maketrans("", "", ".!?")) if fault == 2 else r.text
        damaged.append((r.conv_id, r.turn, role, text, {0: 0, 3: 2}.get(fault, 1)))
    assert results(QUERIES["op11_conversation_repair"](spark, sf)) == brute(damaged)


def test_damage_of_nulls(spark):
    rows = [(None, None, None, None, None, None), (3, None, None, "a.b", None, None)]
    got = {(r.role, r.text) for r in cv.damage(spark.createDataFrame(rows, SCHEMA)).collect()}
    faults = [zlib.crc32(name.encode()) % 20 for name in (" : ", "3: ")]
    texts = [" ", "a.b"]
    want = {
        ("user" if f == 4 else " ", "" if f == 1 else t.replace(".", "") if f == 2 else t)
        for f, t in zip(faults, texts, strict=True)
    }
    assert got == want
