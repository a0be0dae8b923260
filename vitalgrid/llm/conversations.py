"""Repair of the turn structure of conversations by aligning them with an alternating grammar.

A repaired conversation is empty, or an optional system turn followed by one or more pairs of user
and assistant turns. Edits and costs: keep a turn 0, give it the role user or assistant 2, delete it
3, insert an empty user or assistant turn 2; a turn that breaks off costs 1 more unless deleted, and
blank turns and turns that repeat an earlier one have to be deleted. The audit is the string of the
edits' initials (D, I, K, R) of the cheapest repair, the ASCII-least of several.

Method. For every feasible length of the grammar string the turns are aligned with it by
Wagner-Fischer tables whose diagonals are cut to an Ukkonen band: a cell is left out if passing
through it costs more than the cheapest repair found so far. Backtraced audits of equal cost are
compared. A conversation may hold any share of all rows, so it is aligned in blocks of BLOCK turns,
each from every place in the grammar at which it can begin (nothing yet, after system, after user,
after assistant), and the blocks' results are chained. The order of an edit string's characters
decides between strings of equal cost to the same place before its end: one is never the beginning
of the other, since it would then have fewer insertions and cost less.

Spark work: turns are counted per (conversation, turn, role, digest) and first occurrences found by
partial aggregates, so neither a conversation nor a repeated turn meets in one task; blocks are cut
from a range partitioning by (conversation, turn), which spreads a long conversation. Only the
chained block results, and the hash of a conversation's repaired text, which SHA-256 defines one
byte after the other, run through one task per conversation, as streams of bounded memory beside
the audit.

Results for odd rows. Nulls in role or text count as one space: such a text is blank, such a role
has to be changed. Turns are ordered by turn number, missing ones first, then by role and SHA-256 of
role and text. Rows repeated in the table are turns repeated in the conversation. Rows without a
conversation id form one conversation, whose id is null. A conversation left without turns has
counts and cost 0 and an empty audit. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import bound_batches, saved

BLOCK = 64
DELETE, INSERT, REROLE, BROKEN = 3, 2, 2, 1
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
# Places in the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
COMPLETE = (START, ASSISTANT)


def grammar_string(place: int, length: int, system: bool) -> str:
    """The ``length`` symbols that follow ``place``; with a leading system turn if asked for."""
    first = "s" if system else ""
    pairs = "au" if place == USER else "ua"
    return first + (pairs * (length // 2 + 1))[: length - len(first)]


def aligned(turns: str, target: str, limit: int) -> tuple[int, str] | None:
    """(cost, least audit) of turning ``turns`` into ``target``, or None above ``limit``.

    A turn is x (to be deleted) or the initial of its role (o: another one), in upper case if broken.
    """
    n, m = len(turns), len(target)
    apart = n - m
    if (DELETE * apart if apart > 0 else -INSERT * apart) > limit:
        return None
    # Diagonal d = i - j costs 3d down or -2d across to reach, and likewise to come back from.
    both = DELETE + INSERT
    low, high = -((limit - DELETE * apart) // both), (limit + INSERT * apart) // both
    worst = limit + 1
    tables: list[tuple[int, list[int]]] = [(0, [])] * (n + 1)
    below_from, below = 0, []
    for i in range(n, -1, -1):
        begin, end = max(0, i - high), min(m, i - low)
        row = [worst] * (end - begin + 1)
        for j in range(end, begin - 1, -1):
            best = 0 if i == n and j == m else worst
            if i < n:
                at = j - below_from
                if 0 <= at < len(below):
                    best = below[at] + DELETE
                if j < m and turns[i] != "x" and 0 <= at + 1 < len(below):
                    step = below[at + 1] + _change(turns[i], target[j])
                    best = min(best, step)
            if j < end and target[j] != "s":
                best = min(best, row[j + 1 - begin] + INSERT)
            row[j - begin] = best
        tables[i] = (begin, row)
        below_from, below = begin, row
    cost = tables[0][1][0] if tables[0][0] == 0 else worst
    if cost > limit:
        return None

    def left(i: int, j: int) -> int:
        begin, row = tables[i]
        return row[j - begin] if 0 <= j - begin < len(row) else worst

    audit, i, j = [], 0, 0
    while i < n or j < m:
        rest = left(i, j)
        if i < n and left(i + 1, j) + DELETE == rest:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and left(i, j + 1) + INSERT == rest:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def _change(turn: str, symbol: str) -> int:
    """Cost of letting a turn stand for a symbol; no turn can be given the role system."""
    broken = BROKEN if turn.isupper() else 0
    if turn.lower() == symbol:
        return broken
    return broken + (REROLE if symbol != "s" else 10**9)


@lru_cache(maxsize=50_000)
def block_repairs(turns: str, place: int) -> tuple[tuple[int, int, str], ...]:
    """(end place, cost, least audit) for every place that can be reached from ``place``."""
    n = len(turns)
    best: dict[int, tuple[int, str]] = {}
    # Lengths by distance from the number of turns: the first ones give a tight incumbent.
    for length in sorted(range(2 * n + 3), key=lambda m: (abs(m - n), m)):
        for system in (False, True) if place == START and length else (False,):
            target = grammar_string(place, length, system)
            end = AFTER[target[-1]] if target else place
            bound = best[end][0] if end in best else DELETE * n + INSERT * (length + 1)
            found = aligned(turns, target, bound)
            if found is not None and (end not in best or found < best[end]):
                best[end] = found
    return tuple((end, *found) for end, found in best.items())


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of at most BLOCK turns of each conversation with their counts and repairs."""
    names = ["conv", "turn", "role", "digest", "n", "blank", "broken", "new"]
    out: list[dict] = []
    block: dict | None = None

    def opened(conv, part: int) -> dict:
        return {
            "conv": conv, "part": part, "turn": None, "role": None, "digest": None, "codes": [], "blank": 0,
            "duplicate": 0, "truncated": 0, "illegal": 0, "first": None, "last": None, "turns": 0,
            "first_turn": None, "last_turn": None,
        }

    def closed(b: dict) -> dict:
        turns = "".join(b.pop("codes"))
        repairs = [(p, *r) for p in range(4) for r in block_repairs(turns, p)]
        return b | {
            "n": len(turns),
            "origins": [r[0] for r in repairs],
            "ends": [r[1] for r in repairs],
            "costs": [r[2] for r in repairs],
            "audits": [r[3] for r in repairs],
        }

    for batch in batches:
        for conv, turn, role, digest, n, blank, broken, new in zip(
            *(batch.column(c).to_pylist() for c in names), strict=True
        ):
            if block is None or conv != block["conv"]:
                if block is not None:
                    out.append(closed(block))
                block = opened(conv, 0)
            initial = role[:1]
            known = initial if initial in ("s", "u", "a") else "o"
            for copy in range(n):
                if len(block["codes"]) == BLOCK:
                    out.append(closed(block))
                    block = opened(conv, block["part"] + 1)
                if not block["codes"]:
                    block.update(turn=turn, role=role, digest=digest, first=initial)
                else:
                    block["illegal"] += block["last"] + initial not in LEGAL
                block["last"] = initial
                if turn is not None and turn != block["last_turn"]:
                    block["turns"] += 1
                    block["last_turn"] = turn
                    if block["first_turn"] is None:
                        block["first_turn"] = turn
                if blank or copy or not new:
                    block["codes"].append("x")
                    block["blank" if blank else "duplicate"] += 1
                else:
                    block["codes"].append(known.upper() if broken else known)
                    block["truncated"] += broken
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if block is not None:
        out.append(closed(block))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


class _Chain:
    """Repairs of the blocks of one conversation, put one after the other."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.open: dict[int, tuple[int, str]] = {START: (0, "")}
        self.settled: list[str] = []  # beginning of the audit that all open repairs share
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.last = self.first_turn = self.last_turn = None

    def add(self, b: dict) -> None:
        if not b["n"]:
            return
        following: dict[int, tuple[int, str]] = {}
        for origin, end, cost, audit in zip(b["origins"], b["ends"], b["costs"], b["audits"], strict=True):
            if origin in self.open:
                found = (self.open[origin][0] + cost, self.open[origin][1] + audit)
                following[end] = min(found, following.get(end, found))
        shared = os.path.commonprefix([audit for _, audit in following.values()])
        self.settled.append(shared)
        self.open = {end: (cost, audit[len(shared) :]) for end, (cost, audit) in following.items()}
        for name in self.counts:
            self.counts[name] += b[name]
        if self.last is not None:
            self.counts["illegal"] += self.last + b["first"] not in LEGAL
        self.last = b["last"]
        if b["first_turn"] is not None:
            if self.first_turn is None:
                self.first_turn = b["first_turn"]
            elif b["first_turn"] == self.last_turn:
                self.counts["turns"] -= 1
            self.last_turn = b["last_turn"]

    def result(self) -> dict:
        cost, audit = min(self.open[p] for p in COMPLETE if p in self.open)
        turns = self.counts.pop("turns")
        span = self.last_turn - self.first_turn + 1 if self.first_turn is not None else 0
        return {
            "conv": self.conv,
            "gaps": span - turns,
            **self.counts,
            "cost": cost,
            "audit": "".join(self.settled) + audit,
        }


def _chained(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    chain: _Chain | None = None
    for batch in batches:
        out = []
        for b in batch.to_pylist():
            if chain is None or b["conv"] != chain.conv:
                if chain is not None:
                    out.append(chain.result())
                chain = _Chain(b["conv"])
            chain.add(b)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if chain is not None:
        yield pa.RecordBatch.from_pylist([chain.result()], schema=schema)


def _edited(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Apply audits to turns: rows come sorted, the audit of a conversation before its turns."""
    names = ["conv", "audit", "turn", "role", "text", "copies"]
    conv, audit, at, place, position = None, "", 0, START, 0
    out: list[dict] = []

    def symbol() -> str:
        return "a" if place == USER else "u"

    def put(edit: str, turn, role: str, text: str, initial: str) -> None:
        nonlocal place, position
        out.append({"conv": conv, "position": position, "edit": edit, "turn": turn, "role": role, "text": text})
        place, position = AFTER[initial], position + 1

    def insertions() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            s = symbol()
            put("I", None, ROLES[s], "", s)
            at += 1

    for batch in batches:
        size = 0
        for c, new_audit, turn, role, text, copies in zip(
            *(batch.column(x).to_pylist() for x in names), strict=True
        ):
            if new_audit is not None:
                insertions()
                conv, audit, at, place, position = c, new_audit, 0, START, 0
                continue
            for _ in range(copies):
                insertions()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put("K", turn, role, text, role[:1])
                elif edit == "R":
                    s = symbol()
                    put("R", turn, ROLES[s], text, s)
            size += len(text)
            if size > 1 << 20:
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    insertions()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _hashed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ``role:text`` of a conversation's turns, joined by newlines."""
    conv, state = None, None
    for batch in batches:
        out = []
        for c, position, role, text in zip(
            *(batch.column(x).to_pylist() for x in ("conv", "position", "role", "text")), strict=True
        ):
            if position == 0:
                if state is not None:
                    out.append({"conv": conv, "repaired_sha256": state.hexdigest()})
                conv, state = c, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": state.hexdigest()}], schema=schema)


def _plain(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    given = turns.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.col(copies).cast("long") if copies else F.lit(1).cast("long")).alias("copies"),
    )
    digest = F.sha2(F.concat_ws("\n", F.length("role"), "role", "text"), 256)
    return given.withColumn("digest", F.unhex(digest))


def _same(*names: str) -> Column:
    on = F.lit(True)
    for name in names:
        on = on & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    return on


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def audit_conversations(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: str | None = None,
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation.

    A row counts ``copies`` times, one after the other; with 0 it only names its conversation.
    """
    spark = turns.sparkSession
    bound_batches(spark)
    kind = dict(turns.dtypes)[conv_id]
    rows = _plain(turns, conv_id, turn, role, text, copies)
    end = F.rtrim("text", F.lit(SPACE))
    small = rows.select(
        "conv", "turn", "role", "digest", "copies",
        (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("broken"),
    )
    # Where (role, text) first occurs, as a mark on that turn; turns without a number come first.
    firsts = (
        small.where("copies > 0")
        .groupBy("conv", "role", "digest")
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
        .select("conv", F.col("first.turn").alias("turn"), "role", "digest", F.lit(0).cast("long").alias("copies"), F.lit(True).alias("new"))
    )
    counted = (
        small.unionByName(firsts, allowMissingColumns=True)
        .groupBy("conv", "turn", "role", "digest")
        .agg(
            F.sum("copies").alias("n"),
            F.max("blank").alias("blank"),
            F.max("broken").alias("broken"),
            F.coalesce(F.max("new"), F.lit(False)).alias("new"),
        )
    )
    order = ["conv", "turn", "role", "digest"]
    counted = saved(counted, "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    block_ddl = (
        f"conv {kind}, part long, turn long, role string, digest binary, n long, blank long, duplicate long, "
        "truncated long, illegal long, first string, last string, turns long, first_turn long, last_turn long, "
        "origins array<int>, ends array<int>, costs array<long>, audits array<string>"
    )
    block_schema = _arrow(spark, block_ddl)
    blocks = counted.mapInArrow(lambda it: _cut(it, block_schema), block_ddl)
    chain_ddl = f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    chain_schema = _arrow(spark, chain_ddl)
    chained = (
        blocks.repartition("conv")
        .sortWithinPartitions(*order, "part")
        .mapInArrow(lambda it: _chained(it, chain_schema), chain_ddl)
    )
    return chained.withColumnRenamed("conv", conv_id)


def repaired_turns(
    turns: DataFrame,
    audits: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: str | None = None,
) -> DataFrame:
    """(conv_id, position, edit, turn, role, text): the turns that ``audits`` keep, change or insert.

    The rows of a conversation lie in one partition, in order.
    """
    spark = turns.sparkSession
    bound_batches(spark)
    kind = dict(turns.dtypes)[conv_id]
    rows = _plain(turns, conv_id, turn, role, text, copies).where("copies > 0").withColumn("place", F.lit(1))
    heads = audits.select(F.col(conv_id).alias("conv"), "audit", F.lit(0).alias("place"))
    ddl = f"conv {kind}, position long, edit string, turn long, role string, text string"
    schema = _arrow(spark, ddl)
    return (
        heads.unionByName(rows, allowMissingColumns=True)
        .repartition("conv")
        .sortWithinPartitions("conv", "place", "turn", "role", "digest")
        .mapInArrow(lambda it: _edited(it, schema), ddl)
        .withColumnRenamed("conv", conv_id)
    )


def repair_conversations(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: str | None = None,
) -> DataFrame:
    """``audit_conversations`` with ``repaired_sha256``, the hash of each repaired conversation."""
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text, "copies": copies}
    audits = saved(audit_conversations(turns, **names), "audits")
    ddl = f"conv {dict(turns.dtypes)[conv_id]}, repaired_sha256 string"
    schema = _arrow(turns.sparkSession, ddl)
    repaired = repaired_turns(turns, audits, **names).withColumnRenamed(conv_id, "conv")
    hashes = repaired.mapInArrow(lambda it: _hashed(it, schema), ddl)
    joined = audits.alias("a").join(hashes, F.col(f"a.{conv_id}").eqNullSafe(F.col("conv")), "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select("a.*", F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults dealt by a hash of ``conv_id:turn``: turns dropped, emptied, stripped
    of their full stops, repeated, or given to the user. Adds ``copies``: 0, 1 or 2."""
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    fault = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, F.lit(0)).when(fault == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )
