"""Language identification by prediction by partial matching over bytes.

For each language a tree of contexts of up to ``ORDER`` bytes is counted once and then frozen. The
probability of a byte is that of its longest known context; a byte not seen there is reached by
an escape, whose weight is the number of different bytes seen (method C), and shares the escape by
what the next shorter context gives the bytes not seen. The code length of a text is the sum of
-log2 over its bytes; the language with the shortest code is predicted, and the score is its
share among the languages' likelihoods.

Because the statistics are frozen, the code length of a byte depends on its context alone: all
lengths are tabulated, and texts are scored by table lookups on whole batches of bytes.

Fitting uses a bounded sample: of the different texts of each language, pieces of about ``PIECE``
bytes by hash up to about ``TRAIN_BYTES``; equal pieces count once, and the first piece of the first
text in hash order is always among them, so that no language is lost. Contexts seen fewer than ``LEAST`` times are left to shorter ones, and the table
keeps at most ``TABLE_BYTES``, the commonest contexts first.

Results: a null text or one without a letter is ``und`` with score 0, as is every text if nothing
could be learned. Repeated rows get equal results. Ties go to the first language in code point
order. A null doc_id is kept. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import bound_batches, text_slices
from vitalgrid.llm.shingles import GRAM_BASE, mix, text_bytes
from vitalgrid.llm.toxicity import fold

ORDER = 3
LEAST = 4
TRAIN_BYTES = 1_500_000
PIECE, SLACK = 1024, 64
TABLE_BYTES = 48 << 20
MAX_LANGUAGES = 1000
BLOCK = 1 << 20
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")

# Letters count without case, other ASCII bytes as one separator.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


class Model(NamedTuple):
    languages: list[str]
    symbol: np.ndarray  # byte -> symbol; the last symbol stands for each byte never seen
    node: np.ndarray  # three symbols before -> context
    bits: np.ndarray  # (context, symbol) x language -> code length


def grams_of(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the ORDER bytes before it, the oldest highest; texts begin after separators."""
    byte = _FOLD[raw].astype(np.uint32)
    out = byte.copy()
    starts = offsets[:-1]
    for k in range(1, ORDER + 1):
        before = np.full(len(byte), 32, np.uint32)
        before[k:] = byte[:-k]
        at = (starts[:, None] + np.arange(k)).ravel()
        limit = np.repeat(offsets[1:], k)
        before[at[at < limit]] = 32
        out |= before << np.uint32(8 * k)
    return out


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over the texts of ``docs``, added up within tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            raw, offsets = text_bytes(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            grams = grams_of(raw, offsets)
            for lang in sorted(set(langs)):
                mine = np.concatenate(
                    [grams[offsets[i] : offsets[i + 1]] for i, x in enumerate(langs) if x == lang]
                )
                values, n = np.unique(mine, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def build(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """Tables of code lengths from gram counts."""
    bytes_of = [(gram >> (8 * k)) & 255 for k in range(ORDER + 1)]
    used = np.unique(np.concatenate(bytes_of))
    width, langs = len(used) + 1, len(languages)
    symbol = np.full(256, width - 1, np.int64)
    symbol[used] = np.arange(len(used))
    parts = [symbol[b] for b in bytes_of]  # the byte itself, then the bytes before it
    missing = 256 - len(used)
    room = max(256, TABLE_BYTES // (4 * width * langs))
    # Order 0 has one context; longer ones are those seen often enough in some language.
    prob = np.zeros((1, width, langs))
    counts = np.zeros((1, width, langs))
    np.add.at(counts, (0, parts[0], lang), n)
    uniform = np.full((1, width, langs), 1 / 256)
    prob = _blend(counts, uniform, missing)
    tables, codes = [prob], [np.zeros(1, np.int64)]
    node = np.zeros(1, np.int64)  # context of every symbol string of the order so far
    base = 1
    code = np.zeros(len(gram), np.int64)
    for k in range(1, ORDER + 1):
        code = code * width + parts[k]
        total = np.zeros(width**k, np.int64)
        np.add.at(total, code, n)
        kept = np.flatnonzero(total >= LEAST)
        kept = np.sort(kept[np.argsort(-total[kept], kind="stable")][: max(0, room - base)])
        # A context is named by the bytes before, the newest first; its parent drops the oldest.
        parent = node[kept // width]
        wider = np.repeat(node, width)
        wider[kept] = base + np.arange(len(kept))
        place = np.full(width**k, -1, np.int64)
        place[kept] = np.arange(len(kept))
        some = place[code] >= 0
        counts = np.zeros((len(kept), width, langs))
        np.add.at(counts, (place[code[some]], parts[0][some], lang[some]), n[some])
        every = np.concatenate(tables)
        tables.append(_blend(counts, every[parent], missing))
        node, base = wider, base + len(kept)
        codes.append(kept)
    bits = -np.log2(np.concatenate(tables)).astype(np.float32)
    return Model(languages, symbol, node.astype(np.int32), bits.reshape(-1, langs))


def _blend(counts: np.ndarray, shorter: np.ndarray, missing: int) -> np.ndarray:
    """Probabilities of a context from its counts and what the next shorter context gives."""
    total = counts.sum(axis=1, keepdims=True)
    kinds = (counts > 0).sum(axis=1, keepdims=True)
    weight = np.ones((1, counts.shape[1], 1))
    weight[0, -1, 0] = missing  # the last symbol stands for that many bytes
    rest = (shorter * weight * (counts == 0)).sum(axis=1, keepdims=True)
    escape = kinds / np.maximum(total + kinds, 1) / np.maximum(rest, 1e-12)
    out = np.where(counts > 0, counts / np.maximum(total + kinds, 1), shorter * escape)
    return np.where(total > 0, np.maximum(out, 1e-12), shorter)


def code_lengths(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text under each language."""
    width = model.symbol.max() + 1
    grams = grams_of(raw, offsets)
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    for begin in range(0, len(raw), BLOCK):
        part = grams[begin : begin + BLOCK]
        context = np.zeros(len(part), np.int64)
        for k in range(1, ORDER + 1):
            context = context * width + model.symbol[(part >> np.uint32(8 * k)) & np.uint32(255)]
        cell = model.node[context].astype(np.int64) * width + model.symbol[part & np.uint32(255)]
        lo = int(np.searchsorted(offsets, begin, side="right")) - 1
        hi = int(np.searchsorted(offsets, begin + len(part), side="left"))
        starts = np.maximum(offsets[lo:hi] - begin, 0)
        full = np.append(starts[1:], len(part)) > starts
        sums = np.add.reduceat(model.bits[cell], starts[full], axis=0, dtype=np.float64)
        out[np.arange(lo, hi)[full]] += sums
    return out


def _edge(raw: bytes, at: int) -> int:
    """Where the piece that ends about ``at`` ends: before a space, else between two characters."""
    space = raw.find(b" ", at, at + SLACK)
    if space >= 0:
        return space
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return min(at, len(raw))


def sample_pieces(docs: DataFrame, keep: dict[str, float], first: dict[str, int]) -> DataFrame:
    """(lang, text): different pieces of the texts, the share ``keep`` of each language, and always
    the first piece of the text with the digest ``first``."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            langs, digests = batch.column("lang").to_pylist(), batch.column("digest").to_pylist()
            own, parts = [], []
            for lang, digest, text in zip(langs, digests, batch.column("text").to_pylist(), strict=True):
                raw = text.encode()
                number = np.arange(-(-len(raw) // PIECE), dtype=np.uint64)
                turn = mix(np.uint64(digest & (2**64 - 1)) ^ mix(number + GRAM_BASE))
                taken = turn.astype(np.float64) < keep.get(lang, 0.0) * 2.0**64
                if keep.get(lang, 0.0) >= 1:
                    taken[:] = True
                if digest == first.get(lang):
                    taken[:1] = True
                for i in np.flatnonzero(taken).tolist():
                    part = raw[_edge(raw, i * PIECE) if i else 0 : _edge(raw, (i + 1) * PIECE)]
                    if part:
                        own.append(lang)
                        parts.append(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.string()), pa.array(parts, pa.binary())], names=["lang", "text"]
            )

    return docs.select("lang", "digest", "text").mapInArrow(pick, "lang string, text binary").distinct()


def fit(docs: DataFrame, folds: int = 4, held: int = 2) -> Model | None:
    """A model from the rows outside the held-out fold; None where there is nothing to learn from."""
    bound_batches(docs.sparkSession)
    learn = docs.where("text <> '' AND lang IS NOT NULL").where(fold(F.col("doc_id"), folds) != held)
    learn = learn.select("lang", F.xxhash64("text").alias("digest"), "text")
    different = learn.select("lang", "digest", F.octet_length("text").alias("size")).distinct()
    sizes = (
        different.groupBy("lang")
        .agg(F.sum("size").alias("n"), F.min("digest").alias("first"))
        .limit(MAX_LANGUAGES + 1)
        .collect()
    )
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    keep = {r["lang"]: min(1.0, TRAIN_BYTES / r["n"]) for r in sizes}
    rows = count_grams(sample_pieces(learn, keep, {r["lang"]: r["first"] for r in sizes})).toPandas()
    languages = sorted(set(rows["lang"]))
    if not languages:
        return None
    lang = np.searchsorted(languages, rows["lang"].to_numpy(str))
    return build(languages, lang, rows["gram"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))


def predict_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most TABLE_BYTES and the node table

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text_slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            letters = np.array([bool(t and LETTER.search(t)) for t in texts])
            names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if model is not None:
                bits = code_lengths(model, *text_bytes(batch.column("text")))
                best = bits.argmin(axis=1)
                share = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
                score = np.where(letters, 1 / share.sum(axis=1), 0.0)
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, letters, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, lang_pred string, score double")
