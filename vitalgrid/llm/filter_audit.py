"""How document filters interact: what each removes in every order, from sorted posting lists.

A part of the corpus keeps, for every filter, the sorted list of the documents failing it. Lists are
cut by ranges of document ids, so a range of any part is a small piece of work of its own. In a
range, the lists are merged k ways: the cursors gallop to a common next bound, and over the short
stretches between bounds the unions of all sets of filters are formed, and the differences between
each filter's list and the union of any others. Only sizes leave a range; they are summed per part
with Spark. What a filter removes at a step depends only on which filters came before it, so 120
orders of five filters need 80 sums.

Documents are dealt to ranges by a range partitioning of (part, id), each partition being cut into
ranges of at most RANGE documents as it streams by: a part with most of the rows has many ranges,
and one task holds one range. Equal rows are counted beforehand and are one place in the lists.

Results for odd rows. A null text counts as empty, a null part as the empty string. An id that
repeats counts once per row, and each row is judged by its own text; a null id is no smaller and no
larger than another, so such a row is never a copy and is none that another one copies. Labels are
looked up by id and count if any row of the id has them; a null id has none. Texts that repeat count
as copies by SHA-256. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import bound_batches, saved

RANGE = 1 << 15  # documents of one part in a range
STRETCH = 1 << 12  # documents between two bounds of a merge
SPACES = r"[\x20\x09-\x0D]+"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that need nothing but the text, by letter."""
    plain = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(plain, F.lit("\x20\x09\x0a\x0b\x0c\x0d"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    capitals = F.length(plain) - F.length(F.translate(plain, bytes(range(65, 91)).decode(), ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(plain),
        "D": F.rlike(plain, F.lit(r"[#$%&*|]")),
    }


def failures(docs: DataFrame, part: str = "lang", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, id, fails, n): rows counted by the bits of the filters A to E that they fail."""
    plain = docs.select(
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
        _bits(text_filters(F.col(text))).alias("fails"),
    )
    rows = saved(plain.groupBy("part", "id", "digest", "fails").agg(F.count(F.lit(1)).alias("n")), "judged")
    # The first row of each text, met by (digest, id): a text with many copies is no hot key.
    firsts = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id"))
    first = rows.join(firsts.withColumn("first", F.lit(True)), ["digest", "id"], "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return first.select("part", "id", F.when(copy, F.col("fails") + 16).otherwise(F.col("fails")).alias("fails"), "n")


def _bits(filters: Mapping[str, Column]) -> Column:
    return reduce(
        lambda a, b: a + b, (F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(filters.values()))
    )


def labelled(rows: DataFrame, labels: DataFrame, marks: Mapping[str, Column], id_col: str = "doc_id") -> DataFrame:
    """Rows with a boolean column for each mark, true where a label row of the id has it."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        *(F.max(F.coalesce(mark, F.lit(False))).alias(name) for name, mark in marks.items())
    )
    counted = rows.groupBy("part", "id", "fails").agg(F.sum("n").alias("n"))
    return counted.join(known, "id", "left").select(
        "part", "id", "fails", "n", *(F.coalesce(F.col(name), F.lit(False)).alias(name) for name in marks)
    )


def posting_lists(rows: DataFrame, filters: int, marks: Sequence[str]) -> DataFrame:
    """(part, low, high, n, places, counts, lists, marked): one row per part and range of ids.

    ``counts`` holds the rows that each place of the range stands for, in order of ids; ``lists`` per
    filter, and ``marked`` per mark, the sorted places that fail or have it.
    """
    bound_batches(rows.sparkSession)
    marks = list(marks)
    kind = dict(rows.dtypes)["id"]
    ddl = (
        f"part string, low {kind}, high {kind}, n long, places int, counts array<long>, "
        "lists array<array<int>>, marked array<array<int>>"
    )

    def lists_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            fails, counts = t["fails"].to_numpy(), t["n"].to_numpy()
            marked = [np.flatnonzero(t[m].to_numpy()) for m in marks]
            lists = [np.flatnonzero(fails >> i & 1) for i in range(filters)]
            ids = t["id"]
            nested = pa.list_(pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.string()),
                    pa.array([ids[0].as_py()], ids.type),
                    pa.array([ids[-1].as_py()], ids.type),
                    pa.array([int(counts.sum())], pa.int64()),
                    pa.array([len(counts)], pa.int32()),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([[x.astype(np.int32) for x in lists]], nested),
                    pa.array([[x.astype(np.int32) for x in marked]], nested),
                ],
                names=["part", "low", "high", "n", "places", "counts", "lists", "marked"],
            )

        size = 0
        for batch in batches:
            begin = 0
            names = batch.column("part").to_pylist()
            for at, name in enumerate([*names, None]):
                ended = at == len(names)
                if not ended and name == part and size + at - begin < RANGE:
                    continue
                if at > begin:
                    held.append(batch.slice(begin, at - begin))
                    size += at - begin
                    begin = at
                if not ended:
                    if held:
                        yield flush()
                    part, held, size = name, [], 0
        if held:
            yield flush()

    order = ["part", "id", "fails"]
    ordered = rows.select("part", "id", "fails", "n", *marks).repartitionByRange(*order)
    return ordered.sortWithinPartitions(*order).mapInArrow(lists_of, ddl)


def gallop(places: np.ndarray, start: int, bound: int) -> int:
    """First position from ``start`` on that holds ``bound`` or more, by doubled steps."""
    step, low = 1, start
    while low + step < len(places) and places[low + step] < bound:
        low += step
        step *= 2
    return low + int(np.searchsorted(places[low : low + step + 1], bound))


def stretches(lists: Sequence[np.ndarray], places: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Merge sorted lists: (low, bound, the lists' places between them), stretches without any left out."""
    cursors = [0] * len(lists)
    while True:
        heads = [x[c] for x, c in zip(lists, cursors, strict=True) if c < len(x)]
        if not heads:
            return
        low = int(min(heads))
        bound = min(low + STRETCH, places)
        ends = [gallop(x, c, bound) for x, c in zip(lists, cursors, strict=True)]
        yield low, bound, [x[c:e] for x, c, e in zip(lists, cursors, ends, strict=True)]
        cursors = ends


def range_sizes(counts: np.ndarray, lists: Sequence[np.ndarray], marked: Sequence[np.ndarray]) -> dict[tuple[int, int], list[int]]:
    """Per (filter, set of others): rows in the filter's list beyond the union of the others' lists,
    rows shared with that union, and of the former those with each mark."""
    k = len(lists)
    cases = [(f, others) for f in range(k) for others in range(1 << k) if not others >> f & 1]
    totals = {case: [0] * (2 + len(marked)) for case in cases}
    at = [0] * len(marked)
    for low, bound, parts in stretches(lists, len(counts)):
        weight = counts[low:bound]
        flags = []
        for i, places in enumerate(marked):
            begin = gallop(places, at[i], low) if len(places) else 0
            at[i] = gallop(places, begin, bound) if len(places) else 0
            own = np.zeros(bound - low, bool)
            own[places[begin : at[i]] - low] = True
            flags.append(own)
        unions = [np.zeros(0, np.int64)]
        for chosen in range(1, 1 << k):
            top = chosen.bit_length() - 1
            unions.append(_union(unions[chosen ^ (1 << top)], parts[top]))
        for f, others in cases:
            alone = _difference(parts[f], unions[others]) - low
            total = totals[f, others]
            removed = int(weight[alone].sum())
            total[0] += removed
            total[1] += int(weight[parts[f] - low].sum()) - removed
            for i, own in enumerate(flags):
                total[2 + i] += int(weight[alone[own[alone]]].sum())
    return totals


def _union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = np.sort(np.concatenate([a, b]), kind="stable")  # merges two sorted runs
    return both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both


def _difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not len(b):
        return a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return a[b[at] != a]


def interaction_sizes(postings: DataFrame, filters: int, marks: Sequence[str]) -> DataFrame:
    """(part, filter, before, removed, redundant, <marks>): sums over all ranges of a part.

    ``before`` has the bits of the filters applied earlier.
    """
    marks = list(marks)
    ddl = "part string, filter int, before int, removed long, redundant long" + "".join(f", `{m}` long" for m in marks)
    names = ["part", "filter", "before", "removed", "redundant", *marks]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.column("part")[row].as_py()
                counts = batch.column("counts")[row].values.to_numpy()
                lists = [x.values.to_numpy(zero_copy_only=False) for x in batch.column("lists")[row]]
                marked = [x.values.to_numpy(zero_copy_only=False) for x in batch.column("marked")[row]]
                found = range_sizes(counts, lists, marked)
                rows = [(part, f, before, *total) for (f, before), total in found.items()]
                types = [pa.string(), pa.int32(), pa.int32(), *([pa.int64()] * (2 + len(marks)))]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return (
        postings.mapInArrow(sizes, ddl)
        .groupBy("part", "filter", "before")
        .agg(*(F.sum(c).alias(c) for c in ("removed", "redundant", *marks)))
    )


def all_orders(spark, letters: str) -> DataFrame:
    """(filter_order, step, filter, before): every step of every order of the filters."""
    rows = []
    for order in itertools.permutations(range(len(letters))):
        name, before = "".join(letters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            rows.append((name, step, f, before))
            before |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, before int")


def audit_filters(rows: DataFrame, letters: str, marks: Sequence[str]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, <mark>_lost, shapley).

    ``rows`` has (part, id, fails, n) and a boolean column for each mark; bit i of ``fails`` stands
    for the filter letters[i]. ``shapley`` sums what the filter of the step removes over all orders.
    """
    k, marks = len(letters), list(marks)
    postings = saved(posting_lists(rows, k, marks), "postings")
    sums = saved(interaction_sizes(postings, k, marks), "sums")
    docs = postings.groupBy("part").agg(F.sum("n").alias("docs"))
    # A filter stands behind a given set in as many orders as that set and the rest can be arranged.
    ways = F.element_at(
        F.array(*(F.lit(math.factorial(s) * math.factorial(k - 1 - s)) for s in range(k))), F.bit_count("before") + 1
    )
    per_filter = sums.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * ways).cast("long").alias("shapley"),
        F.max(F.when(F.bit_count("before") == k - 1, F.col("removed"))).alias("unique_fails"),
    )
    per_case = sums.join(per_filter, ["part", "filter"]).join(docs, "part")
    gone = F.expr("aggregate(slice(steps, 1, s.step), 0L, (a, x) -> a + x.removed)")
    columns = ["step", "removed", "redundant", "unique_fails", "shapley", "docs", *marks]
    # All steps of one order of one part: as many rows as there are filters.
    orders = (
        per_case.join(all_orders(rows.sparkSession, letters), ["filter", "before"])
        .groupBy("part", "filter_order")
        .agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("steps"))
    )
    return orders.withColumn("s", F.explode("steps")).select(
        "part", "filter_order", "s.step", (F.col("s.docs") - gone).alias("kept"), "s.removed", "s.redundant",
        "s.unique_fails", *(F.col(f"s.{m}").alias(f"{m}_lost") for m in marks), "s.shapley",
    )
