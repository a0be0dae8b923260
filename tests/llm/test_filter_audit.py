"""Filter interactions against counting every order over every document."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import filter_audit as fa

DOCS = "doc_id long, text string, lang string, source string, fails string, n string"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels) -> dict:
    first: dict = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    judged: dict = {}
    for doc_id, text, lang in docs:
        x = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        fails = ("A" if len(w) < 200 else "") + ("B" if 100 * len(set(w)) < 50 * len(w) else "")
        fails += "C" if 100 * sum("A" <= c <= "Z" for c in x) > 3 * len(x) else ""
        fails += "D" if set(x) & set("#$%&*|") else ""
        fails += "E" if doc_id is not None and first[x] < doc_id else ""
        judged.setdefault(lang or "", []).append((fails, doc_id is not None and doc_id in good, doc_id is not None and doc_id in toxic))
    out = {}
    for part, own in judged.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                lost = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(lost)
                out[part, order, step] = [
                    len(left), len(lost), sum(f in d[0] for d in own) - len(lost), sum(d[0] == f for d in own),
                    sum(d[1] for d in lost), sum(d[2] for d in lost),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {key: tuple(row) for key, row in out.items()}


def results(spark, docs, labels) -> dict:
    d = spark.createDataFrame([(*r, "s", "x", "y") for r in docs], DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = fa.labelled(fa.failures(d), lab, {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
    found = fa.audit_filters(rows, "ABCDE", ["good", "toxic"]).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in found}
    assert len(got) == len(found)
    return got


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    docs = []
    for i in range(160):
        n = draw.choice([0, 3, 199, 200, 260])
        w = [draw.choice(["So", "so", "it", "is"]) if draw.random() < 0.6 else f"w{draw.randrange(999)}" for _ in range(n)]
        text = draw.choice([" ", "\t", "\n "]).join(w) + draw.choice(["", "", " 5 %", " A B C|"])
        docs.append((i, draw.choice([text, text, text, None, "", "Copy of one text."]), draw.choice(["en", "de", None, ""])))
    docs += [docs[20]] * 4 + [(None, "Copy of one text.", "en"), (None, None, None), (30, "other text of the id", "de")]
    docs += [(900, "long words here # " * 20000, "fr")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 150, 2)]
    return docs, [*labels, (2, 1, 1), (2, 0, 0), (None, 1, 1), (5000, 1, 1)]


def test_every_order(spark, rows):
    assert results(spark, *rows) == brute(*rows)


def test_small_ranges_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(fa, "RANGE", 7)
    monkeypatch.setattr(fa, "STRETCH", 3)
    failed = spark.createDataFrame(
        [("p", i, (i * 7) % 32, 1 + i % 3, i % 2 == 0) for i in range(500)], "part string, id long, fails int, n long, good boolean"
    )
    counts = np.array([1 + i % 3 for i in range(500)])
    lists = [np.array([i for i in range(500) if (i * 7) % 32 >> f & 1]) for f in range(5)]
    good = np.arange(0, 500, 2)
    whole = fa.range_sizes(counts, lists, [good])
    for (f, others), (removed, redundant, lost) in whole.items():
        union = set().union(*(lists[g].tolist() for g in range(5) if others >> g & 1))
        alone = [i for i in lists[f] if i not in union]
        assert removed == counts[alone].sum()
        assert redundant == counts[lists[f]].sum() - removed
        assert lost == sum(counts[i] for i in alone if i % 2 == 0)
    postings = fa.posting_lists(failed, 5, ["good"])
    assert postings.agg(F.sum("n")).first()[0] == counts.sum()
    sums = fa.interaction_sizes(postings, 5, ["good"]).collect()
    assert {(r["filter"], r.before): [r.removed, r.redundant, r.good] for r in sums} == whole


def test_gallop():
    places = np.array([2, 3, 5, 8, 13, 21, 34, 55])
    for start in range(9):
        for bound in range(60):
            want = next((i for i in range(start, 8) if places[i] >= bound), 8)
            assert fa.gallop(places, start, bound) == want


def test_empty_tables(spark, rows):
    assert results(spark, [], []) == {}
    assert results(spark, rows[0], []) == brute(rows[0], [])
