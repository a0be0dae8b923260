"""Benchmark decontamination against a word-by-word search."""

from __future__ import annotations

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import decontamination as dc

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, items string, hit string, n_rows string"
ITEMS = "item_id long, text string, hash string, gram string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items) -> list:
    grams: dict[tuple, set] = {}
    for item_id, text in items:
        w = words(text)
        k = min(len(w), 10)
        for i in range(len(w) - k + 1) if w else ():
            grams.setdefault(tuple(w[i : i + k]), set()).add(item_id)
    sizes = {len(g) for g in grams}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                own = grams.get(tuple(w[i : i + k]))
                if own is not None:
                    hit |= set(range(i, i + k))
                    found |= own
        ids = sorted(i for i in found if i is not None)
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((doc_id, len(w), len(hit), len(ids), tuple(ids), tuple(map(tuple, spans)), bool(hit)))
    return sorted(out, key=str)


def results(df) -> list:
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), tuple((s.begin, s.end) for s in r.spans), r.contaminated)
         for r in df.collect()),
        key=str,
    )


@pytest.fixture(scope="module")
def tables():
    draw = random.Random(4)

    def some(n):
        return [draw.choice("ab ba Ça über été Data data x1 9".split()) for _ in range(n)]

    items = [(i, " ".join(some(draw.randint(1, 30)))) for i in range(25)]
    items += [(40, None), (41, ""), (42, " .,! "), (3, items[3][1]), (50, items[4][1]), (None, "no id but eleven words stand in this line of text")]
    docs = []
    for i in range(60):
        w = some(draw.randint(0, 60))
        if i % 3 == 0:
            w[5:5] = items[draw.randrange(25)][1].upper().replace("Ç", "Ç").split()
        docs.append((i, draw.choice([" ", ", ", "\n"]).join(w)))
    docs += [(100, None), (101, ""), (102, "  ..  "), (103, items[-1][1]), (103, "other text of one id"), (None, docs[3][1]), (None, docs[6][1])]
    docs += [docs[3]] * 3 + [(200, "ab " * 5000 + items[0][1])]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, "x", "y", "z") for d in docs], DOCS),
        spark.createDataFrame([(*i, "x", "y") for i in items], ITEMS),
    )


@pytest.mark.parametrize("block_bytes", [dc.BLOCK_BYTES, 3000])
def test_words_in_windows(spark, tables, block_bytes):
    docs, items = frames(spark, *tables)
    assert results(dc.contamination(docs, items, block_bytes=block_bytes)) == brute(*tables)


def test_gram_blocks_hold_every_gram(spark, tables):
    grams = dc.benchmark_grams(frames(spark, *tables)[1])
    blocks = dc.gram_blocks(grams, 3000)
    assert len(blocks) > 2
    assert sum(b.count() for b in blocks) == grams.count()


def test_equal_hashes_are_verified(spark, tables, monkeypatch):
    """With one hash for all grams only the words themselves decide."""
    monkeypatch.setattr(dc.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    docs, items = tables
    docs = [d for d in docs if d[0] is not None and d[0] < 10]
    assert results(dc.contamination(*frames(spark, docs, items[:8]))) == brute(docs, items[:8])


def test_removal(spark):
    line = "one two three four five six seven eight nine ten"
    docs, items = frames(spark, [(1, f"Start, {line.upper()}! End."), (2, "clean text."), (3, None), (1, "other")], [(1, line)])
    kept = dc.remove_contamination(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("text IS NOT NULL").collect()) == [(1, "other"), (2, "clean text.")]
    cut = dc.remove_contamination(docs, items, spans=True)
    assert {(r.doc_id, r.text, r["items"]) for r in cut.collect()} == {
        (1, "Start! End.", "x"), (2, "clean text.", "x"), (3, None, "x"), (1, "other", "x"),
    }


def test_empty_tables(spark, tables):
    docs, items = frames(spark, *tables)
    no_docs, no_items = frames(spark, [], [])
    assert dc.contamination(no_docs, items).count() == 0
    found = dc.contamination(docs, no_items).collect()
    assert len(found) == docs.count()
    assert not any(r.contaminated for r in found)
    assert dc.remove_contamination(docs, no_items).count() == docs.count()


def test_no_python_in_the_plan(spark, tables):
    plan = dc.contamination(*frames(spark, *tables))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
