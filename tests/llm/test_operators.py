"""The corpus operators on small tables: brute force, round trips, and odd rows."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import byte_bpe, language, licenses, mixing, toxicity, warc
from vitalgrid.llm.fingerprints import fingerprint_documents, near_duplicate_classes
from vitalgrid.llm.nearest import nearest_by_inner_product
from vitalgrid.llm.ngram_join import ngram_classes
from vitalgrid.llm.passages import remove_repeats
from vitalgrid.llm.queries import QUERIES

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sid string"
rng = np.random.default_rng(3)


def sentence(n: int) -> str:
    return " ".join("".join(rng.choice(list("abcdefg"), 4)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    passage, base = sentence(60), sentence(120).split()
    edited = [*base[:60], "other", *base[61:]]
    far = [*base[:20], *sentence(60).split(), *base[80:]]
    texts = [
        " ".join(base), " ".join(base), " ".join(edited), " ".join(far), None, "", "   \n ", "one two",
        "One TWO", f"{sentence(30)} {passage} {sentence(30)}", f"{sentence(20)}\n{passage}\n{sentence(9)}",
        "a " * 5000, sentence(20000), "Released under the MIT License. mit license", "x" * 3000,
    ]
    out = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 0, "clash") for i, t in enumerate(texts)]
    return [*out, out[0], (None, " ".join(base), None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None, size: int) -> set:
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_classes(rows, size: int, percent: int) -> dict:
    sets = [(r[0], shingles(r[1], size)) for r in rows]
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(sets), 2):
        both = len(a & b)
        if both and 100 * both >= percent * (len(a) + len(b) - both):
            x, y = sorted((top(i), top(j)))
            root[y] = x
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return {(doc_id, len(s)): least[top(i)] for i, (doc_id, s) in enumerate(sets)}


def test_ngram_join_against_all_pairs(spark, docs, rows):
    found = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_classes(docs).collect()}
    assert found == brute_classes(rows, 4, 85)
    assert ngram_classes(docs).count() == len(rows)
    assert ngram_classes(empty(spark)).count() == 0


def test_near_duplicates_against_all_pairs(spark, docs, rows):
    found = {(r.doc_id, r.n_shingles): r.class_id for r in near_duplicate_classes(docs).collect()}
    assert found == brute_classes(rows, 5, 80)


def test_fingerprints(spark, docs, rows):
    got = {(r.doc_id, r.edited_sha256): r for r in fingerprint_documents(docs).collect()}
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1] or ""))
    for this, following in zip(order, [*order[1:], order[0]], strict=True):
        text, after = this[1] or "", following[1] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        r = got[this[0], hashlib.sha256(edit.encode()).hexdigest()]
        a, b = shingles(text, 5), shingles(edit, 5)
        assert r.n_chars == len(text)
        assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1)) < 0.25
    prints = {}
    for r in got.values():
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[0] == prints[1] and prints[4] == prints[5] != prints[7]
    assert fingerprint_documents(empty(spark)).count() == 0


def test_minhash_query_gives_near_duplicate_classes(spark, docs, rows, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op7_minhash"](spark, str(tmp_path)).collect()
    want = brute_classes(rows, 5, 80)
    expected = [(r[0], want[r[0], len(shingles(r[1], 5))]) for r in rows]
    assert sorted(((r.doc_id, r.class_id) for r in out), key=str) == sorted(expected, key=str)
    old = fingerprint_documents(docs)
    assert sorted(map(str, old.collect())) == sorted(map(str, spark.createDataFrame(out).select(*old.columns).collect()))


def test_passages_stay_once(spark, docs, rows):
    out = remove_repeats(docs).collect()
    assert len(out) == len(rows) and set(docs.columns) <= set(out[0].asDict())
    passage = rows[9][1].split()[30:90]
    holding = [r.doc_id for r in out if " ".join(passage) in (r.text or "")]
    assert holding == [9]
    kept = {r.doc_id: r.text for r in out}
    assert kept[4] is None and kept[5] == "" and kept[12] == rows[12][1]
    assert remove_repeats(empty(spark)).count() == 0


def test_passages_are_cut_to_their_ends(spark):
    draw = np.random.default_rng(5)
    prose = lambda n: ["".join(draw.choice(list("abcdefghij"), 6)) for _ in range(n)]
    rows, copies = [], {}
    for k in range(60):
        passage = prose(50 + k % 11)
        near = list(passage)
        if k % 2:  # one word changed at a place where the whole keeps Jaccard 0.8
            near = [*(passage := [*passage, *prose(10)])]
            near[int(draw.integers(12, len(near) - 12))] = "other"
            a, b = (shingles(" ".join(x), 5) for x in (passage, near))
            assert len(a & b) >= 0.8 * len(a | b)
        left, right = prose(30), prose(30)
        rows += [(k, " ".join([*prose(30), *passage, *prose(30)])), (1000 + k, " ".join([*left, *near, *right]))]
        copies[1000 + k] = " ".join([*left, *right])
    out = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[k].text == text for k, text in rows if k < 1000)
    wrong = [k for k, rest in copies.items() if out[k].text.split() != rest.split()]
    assert not wrong


def test_repeated_rows_change_no_cut(spark):
    draw = np.random.default_rng(8)
    prose = lambda n: " ".join("".join(draw.choice(list("abcdefghij"), 6)) for _ in range(n))
    rows = []
    for k in range(20):
        short, long = prose(12), prose(45)
        rows += [(k, f"{prose(30)} {short} {prose(30)} {long} {prose(30)}"), (500 + k, f"{prose(9)} {short} {prose(40)} {long}")]
    schema = "doc_id long, text string"
    once = {r.doc_id: r.removed for r in remove_repeats(spark.createDataFrame(rows, schema)).collect()}
    twice = remove_repeats(spark.createDataFrame([*rows, *rows], schema)).collect()
    assert len(twice) == 2 * len(rows) and all(r.removed == once[r.doc_id] for r in twice)


def test_mix_reaches_targets(spark):
    sizes = rng.integers(1, 40, 900)
    rows = [(i, sentence(int(n)), "en", None if i % 90 == 0 else f"s{i % 4 if i % 3 else 0}", 0, "") for i, n in enumerate(sizes)]
    docs = spark.createDataFrame([*rows, (900, None, "en", "empty", 0, "")], SCHEMA)
    first = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    again = {r.doc_id: r.draws for r in mixing.mix_sources(docs).collect()}
    assert all(again[k] == r.draws for k, r in first.items())
    taken, target = {}, {}
    for r in first.values():
        assert r.taken <= 3 * r.size and len({(d.epoch) for d in r.draws}) == len(r.draws)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert sum(target.values()) == pytest.approx(sum(sizes))
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= 20
    assert mixing.mix_sources(empty(spark)).count() == 0


def test_splitting_tree_is_exact():
    quotas = np.array([1000, 3, 0, 517], dtype=np.int64)
    leaves = [mixing.split_path(quotas, 7, k, 1) for k in range(7)]
    assert (sum(c for _, c in leaves) == quotas).all()
    for source in range(4):
        spans = sorted((o[source], o[source] + c[source]) for o, c in leaves if c[source])
        assert all(a[1] == b[0] for a, b in itertools.pairwise(spans))


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 1 << 10), (700, 60), (90, 12)])
def test_bpe_equals_whole_encoding(spark, docs, rows, chunk, overlap):
    enc = byte_bpe.encoding()
    want = sorted((str(r[0]), np.array(enc.encode_ordinary(r[1] or ""), "<u4").tobytes(), (r[1] or "").encode()) for r in rows)
    plain = byte_bpe.encode_rows(docs, chunk=chunk, overlap=overlap)
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in plain.collect()) == [w[:2] for w in want]
    digests = byte_bpe.encode_rows(docs, chunk=chunk, overlap=overlap, digests=True).collect()
    assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in digests) == sorted(
        (d, hashlib.sha256(i).hexdigest(), hashlib.sha256(t).hexdigest()) for d, i, t in want
    )


def test_warc_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", None, "", "<p>é</p>\r\n\r\nWARC/1.1\r\n", "<p>a</p>", "z" * 200_000]
    rows = [(i, None if i == 3 else f"http://x/{i} \n", h, "clash") for i, h in enumerate(html)]
    pages = spark.createDataFrame([*rows, (None, "u", "<p>a</p>", "")], "page_id long, url string, html string, file string")
    got = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    assert len(got) == 8
    for page_id, _, h, _ in rows:
        raw = (h or "").encode()
        r = got[page_id]
        assert r.payload_bytes == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert {k: r.refers_to for k, r in got.items()} == {0: 5, 1: 5, 2: 3, 3: None, 4: None, 5: None, 6: None, None: 5}
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
    everything = warc.archive_round_trip(pages, least=9).collect()
    assert {r.record_type for r in everything} == {"response"}


def test_nearest_recall_and_odd_vectors(spark):
    vectors = rng.standard_normal((3000, 24)) * rng.uniform(0.2, 3, (3000, 1))
    vectors[100:400] = vectors[100]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(vectors)]
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [None] * 24)]
    table = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>")
    found = nearest_by_inner_product(table, table.where("vec_id % 20 = 0"), k=20, block=700, query_block=64)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    exact = np.array([r[1] for r in rows])
    hits = 0
    for q, ranked in got.items():
        score = exact @ exact[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(score)), -score))[:20]
        hits += len({ranked[k][0] for k in ranked} & set(best.tolist()))
        assert sorted(ranked) == list(range(1, 21))
        assert all(abs(score[v] - s) < 1e-9 for v, s in ranked.values())
    assert set(got) == set(range(0, 3000, 20))
    assert hits >= 0.9 * 20 * len(got)
    few = nearest_by_inner_product(table.where("vec_id < 5"), table.where("vec_id = 0"), k=20)
    assert few.count() == 4
    assert nearest_by_inner_product(table.limit(0), table.limit(0)).count() == 0


def test_licenses(spark, docs, rows):
    assert len(licenses.rules()) > 300
    texts = {
        "This is under the GNU Lesser General Public License v2.1.": ("gpl", "gpl,lgpl-2.1"),
        "Licensed under CC BY-NC 4.0.": ("", "cc-by-nc-4.0"),
        "Licensed under the Apache License, Version 2.0.": ("apache", "apache,apache-2.0"),
        "nothing here": ("", ""),
        "It comes with Apache 2.0.": ("", "apache-2.0"),
        "Creative Commons Attribution 4.0": ("", "cc-by-4.0"),
        "seen on boost.org": ("", ""),
    }
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.base_labels, r.labels) for r in licenses.scan_licenses(table).collect()}
    assert list(texts.values()) == [got[i] for i in range(len(texts))]
    scanned = licenses.scan_licenses(docs).collect()
    assert len(scanned) == len(rows)
    mit = next(r for r in scanned if r.doc_id == 13)
    assert (mit.n_words, mit.n_base, mit.first_word, mit.last_word, mit.base_labels) == (7, 2, 3, 5, "mit")
    none = next(r for r in scanned if r.doc_id == 4)
    assert (none.n_words, none.n_base, none.first_word, none.labels, none.score) == (0, 0, None, "", 0.0)
    plan = licenses.scan_licenses(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_gates_let_addresses_and_identifiers_through(spark):
    texts = {"see gnu.org/licenses/fdl-1.3": "gfdl-1.3", "SPDX-License-Identifier: BSL-1.0": "bsl-1.0"}
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(table).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_language(spark):
    words = {"aa": "taka miso ruka", "bb": "shrim plonk grest"}
    texts = [(i, " ".join(rng.choice(words[k].split(), 30)), k) for i, k in enumerate(itertools.islice(itertools.cycle(words), 80))]
    table = spark.createDataFrame([*texts, (90, None, "aa"), (91, "12 !?", "aa"), (92, "taka miso", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.predict_language(table, language.fit(table)).collect()}
    assert all(got[i].lang_pred == k for i, _, k in texts)
    assert got[90].lang_pred == got[91].lang_pred == "und" and got[92].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = language.fit(table.where("lang = 'zz'"))
    assert {r.lang_pred for r in language.predict_language(table, nothing).collect()} == {"und"}


def test_language_of_few_long_texts_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "TRAIN_BYTES", 3000)
    draw = np.random.default_rng(11)
    make = lambda words, n: " ".join(draw.choice(words.split(), n))
    few = {f"l{k}": make(" ".join(3 * chr(97 + k) + x for x in ("taka", "miso", "ruka")), 4000) for k in range(12)}
    rows = [(100 * k + i, few[f"l{k}"], f"l{k}") for k in range(12) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table)
    assert model.languages == sorted(few)
    assert all(r.lang_pred == f"l{r.doc_id // 100}" for r in language.predict_language(table, model).collect())
    # Copies of one text weigh no more than the text itself, pieces cover each text once.
    once = spark.createDataFrame([(2, "ab cd ef", "x"), (5, "gh ij", "x"), (8, "a" * 2500, "x")], table.schema)
    pieces = language.sample_pieces(
        once.unionByName(once).withColumn("digest", F.xxhash64("text")), {"x": 1.0}, {}
    ).collect()
    assert sorted(len(r.text) for r in pieces) == [5, 8, 452, 1024]


def test_code_lengths_are_proper(spark):
    table = spark.createDataFrame([(i, sentence(60), "aa") for i in range(20)], "doc_id long, text string, lang string")
    model = language.fit(table)
    width = model.symbol.max() + 1
    share = np.exp2(-model.bits.astype(float)).reshape(-1, width)
    share[:, -1] *= 256 - (width - 1)
    assert np.allclose(share.sum(axis=1), 1, atol=1e-4)


def test_toxicity(spark):
    plain = [(i, sentence(80)) for i in range(300)]
    bad = [(1000 + i, re.sub(r"(\w+ \w+ \w+ \w+ )", lambda m: m[1] + rng.choice(["zorkwump ", "quibhex "]), sentence(60))) for i in range(120)]
    docs = spark.createDataFrame([*plain, *bad, (5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, 0) for i, _ in plain), *((i, 1) for i, _ in bad), (5000, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([got[i].predicted == 0 for i, _ in plain]) > 0.98
    assert np.mean([got[i].predicted == 1 for i, _ in bad]) > 0.95
    assert got[5000].predicted == got[5001].predicted == 0
    assert not toxicity.fit(docs, labels.where("toxic = 0")).known
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_pipeline_on_the_smallest_tables(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, folder).collect()
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    assert 0 < len(out) and {r.doc_id for r in out} <= {r.doc_id for r in documents.select("doc_id").collect()}
    toxic = spark.read.parquet(f"{folder}/labels.parquet").where(F.col("toxic") == 0)
    assert toxic.count() > 0
