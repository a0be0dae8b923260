"""Stages on odd rows, and passages that must and must not be cut."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from vitalgrid.llm.fingerprints import near_duplicate_classes
from vitalgrid.llm.ngram_join import ngram_classes
from vitalgrid.llm.passages import remove_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = np.random.default_rng(11)


def words(n: int) -> str:
    return " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)


def kept(spark, rows):
    out = corpus_pipeline.keep_one_of_each_class(spark, frame(spark, rows), "")
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_repeated_rows_leave_others_alone(spark):
    odd = [(1, None), (1, None), (2, ""), (2, ""), (None, None), (None, ""), (3, " \n")]
    assert kept(spark, odd) == sorted(odd, key=str)
    text = words(60)
    assert kept(spark, [*odd, (9, text), (9, text), (9, text)]) == sorted([*odd, (9, text)], key=str)


def test_one_row_of_each_class_stays(spark):
    text = words(80)
    near = text.replace(text.split()[40], "other")
    other = words(50)
    assert kept(spark, [(5, text), (5, near), (6, text), (7, other), (8, near)]) in ([(5, text), (7, other)], [(5, near), (7, other)])
    # Rows without an id: each class keeps one, classes do not merge.
    assert len(kept(spark, [(None, text), (None, near), (None, other), (None, other)])) == 2
    assert kept(spark, [(None, text), (4, text)]) == [(None, text)]
    assert kept(spark, []) == []


@pytest.mark.parametrize("classes", [ngram_classes, near_duplicate_classes])
def test_rows_without_an_id_meet_only_their_text(spark, classes):
    """As many texts are fetched as there are sets, not their square."""
    base = [words(30) for _ in range(40)]
    rows = [(None, t) for t in base] + [(None, t.replace(t.split()[0], "x")) for t in base] + [(None, base[0])]
    found = classes(frame(spark, rows))
    assert found.count() == len(rows)
    assert found.where("n_shingles > 0").count() == len(rows)


def test_short_passages_of_several_documents_do_not_add_up(spark):
    """A B and B C stand in two documents, A B C in a third: no two share 20 words."""
    rows = []
    for n in range(40):
        a, b, c = words(9), words(9), words(9)
        rows += [(10 * n, f"{words(20)} {a} {b} {words(20)}"), (10 * n + 1, f"{words(20)} {b} {c} {words(20)}"),
                 (10 * n + 2, f"{words(20)} {a} {b} {c} {words(20)}")]
    for r in remove_repeats(frame(spark, rows)).collect():
        assert r.n_removed == 0, r.doc_id


def test_cut_spans_have_a_like_span_before(spark):
    """Whatever is cut word for word stands in one earlier text, but for a changed word here and there."""
    passages = [words(n) for n in (25, 40, 60, 90)]
    rows = []
    for n in range(60):
        p = passages[n % 4].split()
        if n % 3 == 2:
            p[len(p) // 2] = "changed"
        rows.append((n, f"{words(30)} {' '.join(p)} {words(30)}"))
    texts = dict(rows)
    out = remove_repeats(frame(spark, rows)).collect()
    caught = 0
    for r in out:
        raw = texts[r.doc_id].encode()
        for s in r.removed or ():
            cut = raw[s.begin : s.end].decode().split()
            grams = {tuple(cut[i : i + 5]) for i in range(len(cut) - 4)}
            best = 0.0
            for earlier in range(r.doc_id):
                w = texts[earlier].split()
                known = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
                best = max(best, len(grams & known) / len(grams))
            assert best >= 0.6, (r.doc_id, cut)
        if r.doc_id >= 4 and (r.removed_bytes or 0) > 0.7 * len(passages[r.doc_id % 4]):
            caught += 1
    assert caught >= 0.9 * 56


def test_empty_and_odd_rows_pass_the_stages(spark):
    assert corpus_pipeline.cut_passages(spark, frame(spark, []), "").count() == 0
    assert corpus_pipeline.mix(spark, frame(spark, []), "").count() == 0
    odd = frame(spark, [(None, None), (1, None), (1, ""), (2, "\n")])
    assert corpus_pipeline.cut_passages(spark, odd, "").count() == 4
    assert corpus_pipeline.encode(spark, odd, "").count() == 4


def test_bit_filter_passes_all_it_was_made_of(spark):
    from vitalgrid.llm.common import bit_filter, has_bit

    values = rng.integers(-(2**63), 2**63 - 1, 5000)
    bits = bit_filter(spark.createDataFrame([(int(v),) for v in values], "v long")).value
    assert has_bit(bits, values).all()
    assert has_bit(bits, rng.integers(-(2**63), 2**63 - 1, 20000)).mean() < 0.12
    assert not has_bit(bit_filter(spark.createDataFrame([], "v long")).value, values).any()
