"""Removal of passages that repeat across documents, by MinHash banding of paragraphs.

Paragraphs are found, not assumed: texts repeat passages in the middle of lines as well. Each text
is cut where a hash of two neighbouring words is smallest within ``REACH`` words on both sides, so
equal passages are cut alike whatever surrounds them. Pieces that occur in more than one document,
with gaps of at most ``BRIDGE`` words between them, form a paragraph if they have ``min_words``
words. Paragraphs of one content are one set; sets of five-word shingles colliding in a band are
joined, exact Jaccard decides, and components of the links are the passages. The first occurrence
of a passage (smallest doc_id, then position) stays, every other one is cut out.

Pieces are seeds only for what a text shares with their first occurrence: runs of them are extended
word by word on both sides to where the two texts part, also past one word changed, and 20 words and
exact Jaccard are decided on the extended spans. So a span is cut only if one earlier text holds a
span like it; pieces known from several texts, each of a shorter passage, do not add up.

Results: one row for each row of ``docs``, all columns kept (``text`` shortened). Null stays null,
empty stays empty. Rows of one doc_id count as one document; those of equal text are cut alike. A
null doc_id is smaller than any other. Columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import bit_filter, bound_batches, has_bit, saved, text_slices
from vitalgrid.llm.fingerprints import FIRST, SHINGLE, band_hashes, banded_classes, best_bands, signatures
from vitalgrid.llm.ngram_join import BROADCAST_ROWS, sid_column
from vitalgrid.llm.shingles import GRAM_BASE, WORD_BASE, distinct_per_row, mix, words_of

REACH = 3
BRIDGE = 16
MIN_WORDS = 20
PAD = 64  # words read on each side of a run; a piece is longer in monotonous text only
FUNCTIONS = 64
PERCENT = 80
RECALL = 0.999
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def cut_words(words) -> np.ndarray:
    """Which words begin a piece: the first of each text, and local minima of the pair hashes."""
    n = len(words.hash)
    begins = np.zeros(n, bool)
    firsts = words.rows[:-1][np.diff(words.rows) > 0]
    if not n:
        return begins
    score = words.hash.copy()
    score[1:] = mix(words.hash[1:] * GRAM_BASE + words.hash[:-1])
    # Texts are laid out with REACH empty places between them, so that none sees its neighbour.
    text = np.repeat(np.arange(len(words.rows) - 1), np.diff(words.rows))
    place = np.arange(n) + REACH * (text + 1)
    wide = np.full(place[-1] + REACH + 1, TOP)
    wide[place] = score
    wide[place[firsts]] = TOP
    low, up = np.full(n, TOP), np.full(n, TOP)
    for k in range(1, REACH + 1):
        low = np.minimum(low, wide[place - k])
        up = np.minimum(up, wide[place + k])
    own = wide[place]
    begins = (own < low) & (own <= up)
    begins[firsts] = True
    return begins


SEED = pa.struct(
    [("doc", pa.int64()), ("digest", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("exact", pa.bool_())]
)


def pack_span(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Begin and length of a span of a text, which has at most 2^31 bytes, in one number."""
    return (begin.astype(np.int64) << 31) | (end - begin)


def unpack_span(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = packed >> 31
    return begin, begin + (packed & ((1 << 31) - 1))


def find_pieces(docs: DataFrame, wanted: Broadcast[np.ndarray] | None = None) -> DataFrame:
    """(doc_id, digest, piece, words, bytes): pieces with the packed spans of their word numbers and
    byte positions; ``digest`` tells apart texts that share a doc_id. With a filter, only pieces that
    pass it."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            words = words_of(batch.column("text"))
            at = np.flatnonzero(cut_words(words))
            if not len(at):
                continue
            ends = np.append(at[1:], len(words.hash))
            inner = np.arange(len(words.hash)) - np.repeat(at, ends - at)
            powers = np.ones(int(inner.max()) + 1, np.uint64)
            powers[1:] = WORD_BASE
            powers = np.multiply.accumulate(powers)
            piece = mix(np.add.reduceat(words.hash * powers[inner], at) + (ends - at).astype(np.uint64))
            if wanted is not None:
                keep = has_bit(wanted.value, piece.view(np.int64))
                at, ends, piece = at[keep], ends[keep], piece[keep]
            text = np.searchsorted(words.rows, at, side="right") - 1
            origin = words.offsets[text]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text)),
                    batch.column("digest").take(pa.array(text)),
                    pa.array(piece.view(np.int64)),
                    pa.array(pack_span(at - words.rows[text], ends - words.rows[text])),
                    pa.array(pack_span(words.starts[at] - origin, words.ends[ends - 1] - origin)),
                ],
                names=["doc_id", "digest", "piece", "words", "bytes"],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(
        rows,
        f"doc_id {kind}, digest long, piece long, words long, bytes long",
    )


def find_paragraphs(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, digest, sid, begin, end, seed): runs of pieces that other documents have too; without a
    sid, with a ``seed`` and spans of words, runs to be extended beside their first occurrence."""
    kind = dict(docs.dtypes)["doc_id"]
    order = F.coalesce("doc_id", F.lit(FIRST))
    repeated = saved(
        find_pieces(docs)
        .groupBy("piece")
        .agg(F.min(order).alias("a"), F.max(order).alias("b"))
        .where("a <> b")
        .select("piece"),
        "repeated",
    )
    pieces = saved(find_pieces(docs, bit_filter(repeated)), "pieces")
    repeated = (
        pieces.groupBy("piece")
        .agg(F.min(F.struct(order.alias("doc"), "digest", "words")).alias("at"), F.max(order).alias("last_doc"))
        .where("at.doc <> last_doc")
        .select("piece", "at")
    )
    per_text = (
        pieces.join(repeated, "piece")
        .groupBy("doc_id", "digest")
        .agg(F.collect_list(F.struct("words", "bytes", "piece", (order > F.col("at.doc")).alias("later"), "at")).alias("own"))
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("row", "low", "high", "begin", "end")}
            seeds, seed_rows = [], []
            lists = batch.column("own")
            flat = lists.flatten()
            first, last = unpack_span(flat.field(0).to_numpy())
            begin, end = unpack_span(flat.field(1).to_numpy())
            piece = flat.field(2).to_numpy()
            later = flat.field(3).to_numpy(zero_copy_only=False)
            source, text_of, place = (flat.field(4).field(k).to_numpy() for k in range(3))
            there, there_end = unpack_span(place)
            cuts = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())])
            for row, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                order = a + np.unique(first[a:b], return_index=True)[1]  # a repeated row holds each piece again
                known = order[later[order]]
                for run, exact in chains(known, first, last, source, text_of, there, there_end):
                    seeds.append(
                        {
                            "doc": source[run[0]], "digest": text_of[run[0]], "low": there[run[0]],
                            "high": there_end[run[-1]], "exact": exact,
                            "begin": first[run[0]], "end": last[run[-1]],
                        }
                    )
                    seed_rows.append(row)
                apart = np.flatnonzero(first[order[1:]] - last[order[:-1]] > BRIDGE) + 1
                for run in np.split(order, apart):
                    if (last[run] - first[run]).sum() < min_words:
                        continue
                    value = piece[run].view(np.uint64)
                    turn = np.arange(1, len(run) + 1, dtype=np.uint64)
                    # Bridged gaps are other content: their length belongs to the identity.
                    gaps = np.append(first[run[1:]] - last[run[:-1]], 0).astype(np.uint64)
                    value = mix(value * WORD_BASE + turn) + mix(gaps + turn * GRAM_BASE)
                    out["row"].append(row)
                    out["low"].append(mix(value).sum(dtype=np.uint64))
                    out["high"].append(mix(value ^ GRAM_BASE).sum(dtype=np.uint64))
                    out["begin"].append(begin[run[0]])
                    out["end"].append(end[run[-1]])
            at = pa.array(out["row"] + seed_rows, pa.int64())
            both = np.array([out["low"], out["high"]], np.uint64).T.reshape(-1, 2)
            none = pa.nulls(len(seeds), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at), batch.column("digest").take(at),
                    pa.concat_arrays([sid_column(both), none]),
                    pa.array(out["begin"] + [s["begin"] for s in seeds], pa.int64()),
                    pa.array(out["end"] + [s["end"] for s in seeds], pa.int64()),
                    pa.array([None] * len(out["row"]) + [{k: v for k, v in s.items() if k in SEED.names} for s in seeds], SEED),
                ],
                names=["doc_id", "digest", "sid", "begin", "end", "seed"],
            )

    return per_text.mapInArrow(
        runs,
        f"doc_id {kind}, digest long, sid binary, begin long, end long, "
        "seed struct<doc:long,digest:long,low:long,high:long,exact:boolean>",
    )


def chains(known, first, last, source, text_of, there, there_end) -> Iterator[tuple[np.ndarray, bool]]:
    """Runs of pieces that follow each other in this text and in that of their first occurrence, with
    gaps of at most BRIDGE words, and their parts without a gap."""
    known = known[np.lexsort((first[known], text_of[known], source[known]))]
    if not len(known):
        return
    other = (np.diff(source[known]) != 0) | (np.diff(text_of[known]) != 0)
    here_gap, there_gap = first[known[1:]] - last[known[:-1]], there[known[1:]] - there_end[known[:-1]]
    loose = other | (here_gap > BRIDGE) | (there_gap > BRIDGE) | (there_gap < 0)
    strict = loose | (here_gap != 0) | (there_gap != 0)
    cuts = np.flatnonzero(loose) + 1
    inner = np.flatnonzero(strict) + 1
    for a, b in zip([0, *cuts], [*cuts, len(known)], strict=True):
        yield known[a:b], False
        within = inner[(inner > a) & (inner < b)]
        for c, d in zip([a, *within], [*within, b], strict=True):
            yield known[c:d], True


def short(hashes: np.ndarray) -> np.ndarray:
    """Half of each word hash: enough to compare two spans, and half as much to move."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


def extend(t: np.ndarray, s: np.ndarray, i: int, j: int, exact: bool) -> tuple[int, int]:
    """How far ``t`` from ``i`` and ``s`` from ``j`` on agree, also past single changed words that at
    least SHINGLE equal words follow unless ``exact``."""
    while True:
        n = min(len(t) - i, len(s) - j)
        apart = np.flatnonzero(t[i : i + n] != s[j : j + n])
        n = int(apart[0]) if len(apart) else n
        i, j = i + n, j + n
        for a, b in () if exact else ((1, 1), (1, 0), (0, 1)):
            x, y = t[i + a : i + a + SHINGLE], s[j + b : j + b + SHINGLE]
            if len(x) == len(y) == SHINGLE and (x == y).all():
                i, j = i + a, j + b
                break
        else:
            return i, j


def alike(t: np.ndarray, s: np.ndarray, percent: int) -> bool:
    """Whether the shingle sets of two word sequences have at least this Jaccard similarity."""
    if len(t) == len(s) and (t == s).all():
        return True
    a, b = (
        np.unique(sum(mix(w[k : len(w) - SHINGLE + 1 + k] + np.uint64(k) * GRAM_BASE) for k in range(SHINGLE)))
        for w in (t.astype(np.uint64), s.astype(np.uint64))
    )
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def extended_copies(docs: DataFrame, seeds: DataFrame, min_words: int, percent: int) -> DataFrame:
    """(doc_id, digest, begin, end): byte spans of texts that are like a span of an earlier one."""
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", "text")
    asked = seeds.select("seed.doc", "seed.digest", "seed.low", "seed.high").distinct()
    asked = saved(
        asked.groupBy(F.col("doc").alias("span_doc"), F.col("digest").alias("span_digest")).agg(
            F.collect_list(F.struct("low", "high")).alias("own")
        ),
        "asked",
    )
    # Texts stay where they are if all spans asked for are few enough to be sent to them.
    if (asked.agg(F.sum(F.size("own") + 1)).first()[0] or 0) <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    same = (F.coalesce("doc_id", F.lit(FIRST)) == F.col("span_doc")) & (F.xxhash64("text") == F.col("span_digest"))

    def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            words = words_of(batch.column("text"))
            docs_, digests = batch.column("span_doc").to_pylist(), batch.column("span_digest").to_pylist()
            out = {k: [] for k in ("doc", "text_digest", "low", "high", "base", "words")}
            for i, own in enumerate(batch.column("own").to_pylist()):
                mine = short(words.hash[words.rows[i] : words.rows[i + 1]])
                for p in own:
                    base = max(0, p["low"] - PAD)
                    row = (docs_[i], digests[i], p["low"], p["high"], base, mine[base : p["high"] + PAD].tobytes())
                    for k, v in zip(out, row, strict=True):
                        out[k].append(v)
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out)
            )

    read = (
        texts.join(asked, same)
        .select("text", "span_doc", "span_digest", "own")
        .mapInArrow(snippets, "doc long, text_digest long, low long, high long, base long, words binary")
        .dropDuplicates(["doc", "text_digest", "low", "high"])
    )
    # Texts are known by their id, a missing one made FIRST, and their digest: spans are gathered by the
    # same columns that they meet their text by, so they move once.
    own_doc = F.coalesce("doc_id", F.lit(FIRST)).alias("span_doc")
    keyed = seeds.select(own_doc, F.col("digest").alias("span_digest"), "begin", "end", "seed.*").withColumnRenamed(
        "digest", "text_digest"
    )
    beside = (
        keyed.join(read, ["doc", "text_digest", "low", "high"])
        .groupBy("span_doc", "span_digest")
        .agg(F.collect_list(F.struct("begin", "end", "low", "high", "base", "exact", "words")).alias("own"))
    )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            words = words_of(batch.column("text"))
            row, begins, ends = [], [], []
            for i, own in enumerate(batch.column("own").to_pylist()):
                t0 = int(words.rows[i])
                t = short(words.hash[t0 : words.rows[i + 1]])
                for p in own:
                    s = np.frombuffer(p["words"], np.uint32)
                    end, high = extend(t, s, p["end"], p["high"] - p["base"], p["exact"])
                    back = extend(t[: p["begin"]][::-1], s[: p["low"] - p["base"]][::-1], 0, 0, p["exact"])
                    begin, low = p["begin"] - back[0], p["low"] - p["base"] - back[1]
                    if end - begin >= min_words and alike(t[begin:end], s[low:high], percent):
                        row.append(i)
                        begins.append(words.starts[t0 + begin] - words.offsets[i])
                        ends.append(words.ends[t0 + end - 1] - words.offsets[i])
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at), batch.column("digest").take(at),
                    pa.array(begins, pa.int64()), pa.array(ends, pa.int64()),
                ],
                names=["doc_id", "digest", "begin", "end"],
            )

    keyed_texts = texts.select("doc_id", "text", own_doc, F.xxhash64("text").alias("span_digest"))
    joined = keyed_texts.join(beside, ["span_doc", "span_digest"]).withColumnRenamed("span_digest", "digest")
    return joined.select("doc_id", "digest", "text", "own").mapInArrow(
        decide, f"doc_id {kind}, digest long, begin long, end long"
    )


def _with_text(docs: DataFrame, spans: DataFrame, n_rows: int, how: str) -> DataFrame:
    """Rows of ``docs`` with the spans of their text, matched on doc_id and digest."""
    spans = spans.withColumnsRenamed({"doc_id": "span_doc", "digest": "span_digest"})
    if n_rows <= BROADCAST_ROWS:
        spans = F.broadcast(spans)
    same = F.col("doc_id").eqNullSafe(F.col("span_doc")) & (F.xxhash64("text") == F.col("span_digest"))
    return docs.join(spans, same, how).drop("span_doc", "span_digest")


def passage_classes(docs: DataFrame, paragraphs: DataFrame, percent: int) -> DataFrame:
    """(sid, class): passages of near-equal paragraphs; a paragraph like no other is absent."""
    bands, rows = best_bands(FUNCTIONS, percent / 100, RECALL)
    heads = paragraphs.groupBy("sid").agg(
        F.min(F.struct("doc_id", "digest", "begin", "end")).alias("at"), F.count(F.lit(1)).alias("copies")
    )
    wanted = saved(
        heads.groupBy("at.doc_id", "at.digest").agg(
            F.collect_list(F.struct("sid", "at.begin", "at.end", "copies")).alias("own")
        ),
        "wanted",
    )
    counted = wanted.agg(F.sum(F.size("own"))).first()[0] or 0
    texts = _with_text(docs.select("doc_id", "text"), wanted, counted, "inner").select("text", "own")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            parts, sids, copies = [], [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("own").to_pylist(), strict=True):
                raw = text.encode()
                for p in own:
                    parts.append(raw[p["begin"] : p["end"]])
                    sids.append(p["sid"])
                    copies.append(p["copies"])
            grams, offsets = distinct_per_row(*words_of(pa.array(parts, pa.large_binary())).grams(SHINGLE))
            hashes = band_hashes(signatures(grams, offsets, FUNCTIONS), bands, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sids, pa.binary()),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(copies, pa.int64()),
                    pa.array([grams[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)], pa.binary()),
                    pa.array(list(hashes), pa.list_(pa.int64())),
                ],
                names=["sid", "n", "copies", "grams", "bands"],
            )

    sets = saved(
        texts.mapInArrow(describe, "sid binary, n long, copies long, grams binary, bands array<bigint>"), "paragraphs"
    )
    classes, _ = banded_classes(sets, percent)
    return classes.selectExpr("id AS sid", "component AS class")


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; adds n_removed, removed_bytes and
    ``removed`` (byte spans of the original text)."""
    bound_batches(docs.sparkSession)
    found = saved(find_paragraphs(docs, min_words), "runs")
    paragraphs = found.where("sid IS NOT NULL")
    extended = extended_copies(docs, found.where("seed IS NOT NULL"), min_words, percent)
    classes = passage_classes(docs, paragraphs, percent)
    placed = paragraphs.join(classes, "sid", "left").select(
        "doc_id", "digest", "begin", "end", F.coalesce("class", "sid").alias("class")
    )
    place = F.struct("doc_id", "digest", "begin", "end")
    first = placed.groupBy("class").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("m")).where("m > 1")
    cut = (
        placed.join(first, "class")
        .where(~place.eqNullSafe(F.col("kept")))
        .select("doc_id", "digest", "begin", "end")
        .unionByName(extended)
        .groupBy("doc_id", "digest")
        .agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("removed"))
    )
    cut = saved(cut, "cuts")
    added = ["removed", "n_removed", "removed_bytes"]
    names = [c for c in docs.columns if c not in added]
    joined = _with_text(docs.select(*names), cut, cut.count(), "left")
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in names)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            texts, removed, lost = batch.column("text").to_pylist(), batch.column("removed").to_pylist(), []
            for i, spans in enumerate(removed):
                lost.append(0)
                if spans:
                    raw, out, at = texts[i].encode(), [], 0
                    for s in spans:
                        out.append(raw[at : max(at, s["begin"])])
                        at = max(at, s["end"])
                    texts[i] = (b"".join(out) + raw[at:]).decode()
                    lost[i] = len(raw) - len(texts[i].encode())
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array(texts, pa.string())
            columns["n_removed"] = pa.array([len(s or ()) for s in removed], pa.int32())
            columns["removed_bytes"] = pa.array(lost, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return joined.select(*names, "removed").mapInArrow(
        shorten,
        f"{schema}, removed array<struct<begin:bigint,end:bigint>>, n_removed int, removed_bytes long",
    )
