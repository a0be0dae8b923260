"""Toxicity by compression distance: two Zstandard dictionaries and calibrated window thresholds.

One dictionary is trained on ordinary text. The toxic one holds the same content and, behind it,
the pieces of words that toxic texts use far more often, chosen greedily until all telling four-byte
runs are covered; so the two differ in nothing else. A text is cut at spaces into windows of about
``WINDOW`` bytes, each window is compressed under both, and the bytes the toxic dictionary saves
are its score. A document is described by how many and which share of its windows save at least 1,
2, ... ``STEPS`` bytes; the weights of these thresholds are calibrated on labelled documents by
logistic regression.

Fitting uses a bounded sample of labelled rows: ``TOXIC_DOCS`` and ``ORDINARY_DOCS`` documents by
hash order, and ``TRAIN_BYTES`` of their text for each dictionary. Scoring covers every window of
every text.

Results: null and empty texts have no window and get the score of a text without any saving.
Repeated rows get equal scores. A null doc_id is kept and belongs to no label. Labels of null are
left out; without both kinds of label nothing can be learned and every score is 0. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import bound_batches, text_slices

TOXIC_DOCS, ORDINARY_DOCS = 2500, 5000
TRAIN_BYTES = 4_000_000
CHUNK = 1024
WINDOW, SLACK = 48, 24
DICTIONARY = 8192
RUN = 4
STEPS = 6
RARE = 25
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BREAK = b"\xff"


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    known: bool


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def cut(raw: bytes, size: int, slack: int) -> list[bytes]:
    """Pieces of about ``size`` bytes that end before a space where one comes within ``slack``."""
    out, at = [], 0
    while at < len(raw):
        end = at + size
        if end < len(raw):
            space = raw.find(b" ", end, end + slack)
            end = space if space >= 0 else min(len(raw), end + slack)
        out.append(raw[at:end])
        at = end
    return out


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=14, chain_log=14, search_log=5, min_match=4,
        strategy=zstandard.STRATEGY_LAZY, write_checksum=False, write_content_size=False, write_dict_id=False,
    )
    # Taken as content only: without its entropy tables, a byte not matched costs a byte under both.
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=settings)


class Scorer:
    """Window savings and document features under a pair of dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = _compressor(ordinary), _compressor(toxic)

    def features(self, text: str) -> list[float]:
        plain, toxic = self.ordinary.compress, self.toxic.compress
        windows = cut(text.encode().translate(_LOWER), WINDOW, SLACK)
        saved = Counter(len(plain(w)) - len(toxic(w)) for w in windows)
        n = max(1, len(windows))
        hits = [sum(c for s, c in saved.items() if s >= k) for k in range(1, STEPS + 1)]
        return [*(float(np.log1p(h)) for h in hits), *(10 * h / n for h in hits), float(np.log(n)), 1.0]


def word_counts(texts: list[bytes]) -> Counter:
    """Words with the number of different neighbourhoods they have: copies of a text add nothing."""
    seen, out = set(), Counter()
    for text in texts:
        words = text.split()
        for a, b, c in zip([b"", *words[:-1]], words, [*words[1:], b""], strict=True):
            key = hash((a, b, c))
            if key not in seen:
                seen.add(key)
                out[b" " + b] += 1
    return out


def _run_counts(words: Counter) -> Counter:
    out = Counter()
    for word, n in words.items():
        for run in {word[i : i + RUN] for i in range(len(word) - RUN + 1)}:
            out[run] += n
    return out


def telling_pieces(toxic: Counter, ordinary: Counter) -> list[bytes]:
    """Pieces of words that cover the runs toxic words have far more often, commonest first."""
    share = toxic.total() / max(1, ordinary.total())
    a, b = _run_counts(toxic), _run_counts(ordinary)
    good = {
        run
        for run, n in a.items()
        if n >= 12 * (b[run] * share + 0.25) and n - b[run] * share >= 3.2 * (n + b[run] * share**2) ** 0.5
    }
    pieces, done = [], set()
    for word, _ in sorted(toxic.items(), key=lambda x: (-x[1], x[0])):
        fresh = [i for i in range(len(word) - RUN + 1) if word[i : i + RUN] in good and word[i : i + RUN] not in done]
        if fresh:
            done.update(word[i : i + RUN] for i in fresh)
            for part in np.split(np.array(fresh), np.flatnonzero(np.diff(fresh) > 1) + 1):
                pieces.append(word[part[0] : part[-1] + RUN])
    ours, theirs = (_BREAK.join(w for w, n in x.items() for _ in range(min(n, 50))) for x in (toxic, ordinary))
    share = len(ours) / max(1, len(theirs))

    def telling(piece: bytes) -> bool:
        return ours.count(piece) >= RARE * (theirs.count(piece) * share + 0.3)

    kept = []
    for piece in pieces:
        longest = (
            piece[i : i + n] for n in range(len(piece), RUN - 1, -1) for i in range(len(piece) - n + 1)
        )
        kept += [next((p for p in longest if telling(p)), b"")]
    return [p for p in dict.fromkeys(kept) if p]


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    try:
        common = zstandard.train_dictionary(DICTIONARY, ordinary, level=3).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        common = b"".join(ordinary)[-DICTIONARY:]
    pieces = telling_pieces(word_counts(toxic), word_counts(ordinary))
    return common, common + _BREAK + _BREAK.join(reversed(pieces)) + _BREAK


def calibrate(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method with a small penalty."""
    weights = np.zeros(features.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = (features.T * (p * (1 - p))) @ features + 1e-2 * np.eye(len(weights))
        step = np.linalg.solve(slope, features.T @ (toxic - p) - 1e-2 * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> Model:
    """A model from labelled documents outside the held-out fold."""
    bound_batches(docs.sparkSession)
    learn = labels.where((fold(F.col("doc_id"), folds) != held) & F.col("doc_id").isNotNull())
    picked = None
    for value, most in ((1, TOXIC_DOCS), (0, ORDINARY_DOCS)):
        rows = learn.where(F.col("toxic") == value).select("doc_id", F.lit(float(value)).alias("toxic"))
        rows = rows.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = rows if picked is None else picked.unionByName(rows)
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    texts = texts.select("toxic", "text")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    if not all(sizes.get(float(v)) for v in (0, 1)):
        return Model(b"", b"", (), False)
    keep = {k: min(1.0, TRAIN_BYTES / n) for k, n in sizes.items()}

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [])
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for part in cut(text.encode().translate(_LOWER), CHUNK, CHUNK):
                    if int.from_bytes(hashlib.sha256(part).digest()[:4], "big") < keep[toxic] * 2**32:
                        out[0].append(toxic)
                        out[1].append(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.float64()), pa.array(out[1], pa.binary())], names=["toxic", "part"]
            )

    parts: dict[float, list[bytes]] = {0.0: [], 1.0: []}
    for r in texts.mapInArrow(chunks, "toxic double, part binary").distinct().collect():
        parts[r["toxic"]].append(bytes(r["part"]))
    for p in parts.values():
        p.sort()
    if not all(parts.values()):
        return Model(b"", b"", (), False)
    ordinary, toxic = train_dictionaries(parts[1.0], parts[0.0])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(ordinary, toxic)
        for batch in batches:
            values = [scorer.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(values, pa.list_(pa.float64()))], names=["toxic", "features"]
            )

    measured = texts.mapInArrow(measure, "toxic double, features array<double>").collect()
    x = np.array([r["features"] for r in measured])
    y = np.array([r["toxic"] for r in measured])
    order = np.lexsort((*x.T, y))
    return Model(ordinary, toxic, tuple(calibrate(x[order], y[order]).tolist()), True)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` (those named like the added ones replaced), score and predicted."""
    bound_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    types = dict(docs.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.ordinary, model.toxic) if model.known else None
        weights = np.array(model.weights)
        for batch in text_slices(batches, "text"):
            if scorer:
                x = np.array([scorer.features(t or "") for t in batch.column("text").to_pylist()])
                score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            else:
                score = np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    schema = ", ".join(f"`{c}` {types[c]}" for c in names)
    return docs.select(*names).mapInArrow(work, f"{schema}, score double, predicted int")
