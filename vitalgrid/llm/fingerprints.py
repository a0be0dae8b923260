"""MinHash fingerprints of documents, and near-duplicate classes from their bands.

A fingerprint is the signature of the document's set of word shingles: for each of ``PERMUTATIONS``
random multiply-add hash functions the smallest value over the shingles. The share of equal
positions of two fingerprints estimates the Jaccard similarity of the sets.

Results: null counts as empty text; an empty text has the signature of all ones, equal to that of
other empty texts only. Texts shorter than ``size`` words have one shingle. Repeated rows get equal
fingerprints. A null doc_id is ordered as the smallest id. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import SLICE_BYTES, bit_filter, bound_batches, components, has_bit, saved, text_slices
from vitalgrid.llm.ngram_join import BROADCAST_ROWS, join_clusters, join_placed, placements, sid_column
from vitalgrid.llm.shingles import distinct_per_row, mix, set_hash, words_of

SHINGLE = 5
PERMUTATIONS = 128
CHUNK = 1 << 14
FIRST = -(1 << 63)
PACK_LEVEL = 6


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``n`` multiply-shift hash functions."""
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return seeds[:n] | np.uint64(1), seeds[n:]


def signatures(grams: np.ndarray, offsets: np.ndarray, n: int = PERMUTATIONS) -> np.ndarray:
    """Row signatures, 32 bits for each function: the upper bits of the smallest product."""
    a, b = hash_family(n)
    rows = len(offsets) - 1
    out = np.full((rows, n), np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(grams), CHUNK):
        part = grams[begin : begin + CHUNK]
        lo = int(np.searchsorted(offsets, begin, side="right")) - 1
        hi = int(np.searchsorted(offsets, begin + len(part), side="left"))
        starts = np.maximum(offsets[lo:hi] - begin, 0)
        full = np.append(starts[1:], len(part)) > starts
        at = starts[full]
        row = np.arange(lo, hi)[full]
        for j in range(n):
            least = np.minimum.reduceat(part * a[j] + b[j], at)
            out[row, j] = np.minimum(out[row, j], least)
    return (out >> np.uint64(32)).astype(np.uint32)


def text_signatures(texts: list[str], size: int = SHINGLE, n: int = PERMUTATIONS) -> np.ndarray:
    return signatures(*words_of(pa.array(texts, pa.large_string())).grams(size), n)


def _ordered_with_neighbour(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Rows in buckets of doc_id, falling inside each; a bucket also holds, as ``halo`` rows at its
    end, what follows its last row (for the lowest bucket: the very first row).

    Texts are shuffled compressed, as ``packed``. Only rows whose doc_id repeats keep ``text``, by
    which they are ordered.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("key"), *carried
    )
    n = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = rows.select("key")
    splits = np.unique(
        np.array(keys.approxQuantile("key", [i / n for i in range(1, n)], 0.25 / n) or [], float)
    )

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splits, key.to_numpy().astype(float), side="right"))

    counted = saved(keys.groupBy("key").count(), "keys")
    ends = counted.groupBy(bucket_of("key").alias("bucket")).agg(F.max("key").alias("top")).collect()
    ends = sorted((r["bucket"], r["top"]) for r in ends)  # one row per bucket
    follows: dict[int, list[int]] = {}
    for i, (bucket, _) in enumerate(ends):
        follows.setdefault(ends[i - 1][1], []).append(bucket)

    again = counted.where("count > 1").select("key", F.lit(True).alias("again"))
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=PACK_LEVEL).compress
        for batch in text_slices(batches, "text"):
            key, plain = batch.column("key").to_numpy(), batch.column("again").to_pylist()
            own = np.searchsorted(splits, key.astype(float), side="right")
            texts = batch.column("text").to_pylist()
            packed = [None if p else compress((t or "").encode()) for t, p in zip(texts, plain, strict=True)]
            place = [(i, int(b), False) for i, b in enumerate(own)]
            place += [(i, b, True) for i, k in enumerate(key.tolist()) for b in follows.get(k, ())]
            at = pa.array([i for i, _, _ in place], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("key").take(at),
                    pa.array([texts[i] if plain[i] else None for i, _, _ in place], pa.string()),
                    pa.array([packed[i] for i, _, _ in place], pa.binary()),
                    pa.array([b for _, b, _ in place], pa.int32()),
                    pa.array([h for _, _, h in place], pa.bool_()),
                    *(batch.column(c).take(at) for c in carried),
                ],
                names=["doc_id", "key", "text", "packed", "bucket", "halo", *carried],
            )

    kind = dict(docs.dtypes)["doc_id"]
    placed = rows.join(again, "key", "left").mapInArrow(
        pack,
        f"doc_id {kind}, key long, text string, packed binary, bucket int, halo boolean"
        + "".join(f", {c} {kind}" for c in carried),
    )
    return (
        placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket")
        .sortWithinPartitions("bucket", "halo", F.desc("key"), "text")
        .select("doc_id", "text", "packed", "bucket", "halo", *carried)
    )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (doc_id, text, bucket, halo, ...) in lists of about ``SLICE_BYTES`` of text."""
    expand = zstandard.ZstdDecompressor().decompress
    rows, size = [], 0
    for batch in batches:
        for doc_id, text, packed, *more in zip(*batch.columns, strict=True):
            own = expand(packed.as_py()).decode() if packed.is_valid else text.as_py() or ""
            rows.append((doc_id.as_py(), own, *(v.as_py() for v in more)))
            size += len(own)
            if size >= SLICE_BYTES:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows
    pa.default_memory_pool().release_unused()  # workers live on for other stages


def fingerprint_documents(
    docs: DataFrame, size: int = SHINGLE, n: int = PERMUTATIONS, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Fingerprints of each text and of its edit with the next document, and their likeness.

    The edit replaces the last half of the code points (rounded down) by the first as many of the
    next document's in falling doc_id order, the first following the last; rows with one doc_id
    follow each other by text. Columns ``carried``, of the type of doc_id, are kept as they are.
    """
    bound_batches(docs.sparkSession)

    def done(rows: list[tuple], ahead: tuple | None) -> pa.RecordBatch:
        texts = [r[1] for r in rows]
        following = texts[1:] + ([ahead[1]] if ahead else [])
        edited = [
            t[: len(t) - len(t) // 2] + f[: len(t) // 2]
            for t, f in zip(texts, following, strict=False)
        ]
        keep = [i for i in range(len(edited)) if not rows[i][3]]
        own = text_signatures(texts + ([ahead[1]] if ahead else []), size, n)
        new = text_signatures(edited, size, n)
        same = (own[: len(edited)] == new).mean(axis=1)
        like = (own[: len(edited)] == own[1:]).mean(axis=1)
        hexed = lambda sig: sig.astype(">u4").tobytes().hex()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][0] for i in keep], id_type),
                pa.array([len(texts[i]) for i in keep], pa.int64()),
                pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in keep]),
                pa.array([hexed(own[i]) for i in keep]),
                pa.array([hexed(new[i]) for i in keep]),
                pa.array(same[keep], pa.float64()),
                pa.array(like[keep], pa.float64()),
                *(pa.array([rows[i][4 + k] for i in keep], id_type) for k in range(len(carried))),
            ],
            names=[
                "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                "near_edited", "near_next", *carried,
            ],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        for rows in _unpacked(batches):
            rows = [waiting, *rows] if waiting else rows
            waiting = rows[-1]
            if len(rows) > 1:
                yield done(rows[:-1], waiting)

    kind = dict(docs.dtypes)["doc_id"]
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16()}[kind]
    return _ordered_with_neighbour(docs, list(carried)).mapInArrow(
        work,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
        + "".join(f", {c} {kind}" for c in carried),
    )


def best_bands(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows): the most rows a band may have so that a pair at the threshold still collides
    with at least the given probability."""
    for rows in range(n, 0, -1):
        bands = n // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("no banding of this many functions reaches the recall")


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per row and band; the band number is part of it."""
    value = np.zeros((len(signature), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        value = mix(value ^ signature[:, k : bands * rows : rows].astype(np.uint64))
    return value.view(np.int64)


def banded_classes(
    sets: DataFrame, percent: int, label: str = "near"
) -> tuple[DataFrame, DataFrame]:
    """(id, component) and the stored link table of near-equal sets (sid, n, copies, grams, bands).

    Sets that share a band hash fall into one candidate cluster (each is tied to the smallest of
    its band, so a common band costs as many rows as it has sets); inside clusters the exact
    Jaccard similarity decides.
    """
    links = join_clusters(sets.select("sid", "n", "copies", "grams"), candidate_clusters(sets), percent)
    return components(links.select("a", "b")), links


def candidate_clusters(sets: DataFrame) -> DataFrame:
    """(id, component) of the sets (sid, bands) that share a band hash with another one; a set may
    stand in several rows. Inside, sets go by 64 bits of their sid."""
    tagged = sets.select("sid", F.xxhash64("sid").alias("tag"), "bands")
    band = tagged.select("tag", F.explode("bands").alias("band"))
    hub = band.groupBy("band").agg(F.min("tag").alias("a"), F.max("tag").alias("z")).where("a <> z")
    hub = saved(hub.select("band", "a"), "hubs")
    shared = bit_filter(hub.select("band"))

    def colliding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("bands")
            value = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy())
            keep = has_bit(shared.value, value)
            at = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column("sid").take(at), batch.column("tag").take(at), pa.array(value[keep])],
                names=["sid", "tag", "band"],
            )

    # Few bands have a second set: only those that may are shuffled again.
    again = tagged.mapInArrow(colliding, "sid binary, tag long, band long")
    near = saved(again.join(hub, "band").select("a", "tag", "sid").distinct(), "near")
    found = components(near.where("a <> tag").selectExpr("a", "tag AS b"))
    return near.select("tag", "sid").distinct().join(found.withColumnRenamed("id", "tag"), "tag").select(
        F.col("sid").alias("id"), "component"
    )


def near_duplicate_classes(
    docs: DataFrame, percent: int = 80, size: int = SHINGLE, n: int = PERMUTATIONS, recall: float = 0.999
) -> DataFrame:
    """(doc_id, class_id, n_shingles): class_id is the smallest doc_id reached over pairs whose
    shingle sets have at least ``percent`` % Jaccard similarity, among pairs that share a band.
    Empty texts stand alone.
    """
    return _classes(docs, percent, size, n, recall).select("doc_id", "class_id", "n_shingles")


def _classes(docs: DataFrame, percent: int, size: int, n: int, recall: float) -> DataFrame:
    """near_duplicate_classes with the digest of each row's text. Shingles themselves are read only
    of sets that share a band with another one."""
    bound_batches(docs.sparkSession)
    bands, rows = best_bands(n, percent / 100, recall)
    kind = dict(docs.dtypes)["doc_id"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            grams, offsets = distinct_per_row(*words_of(batch.column("text")).grams(size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    sid_column(set_hash(grams, offsets)),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(list(band_hashes(signatures(grams, offsets, n), bands, rows)), pa.list_(pa.int64())),
                ],
                names=["doc_id", "digest", "sid", "n", "bands"],
            )

    light = saved(
        docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(
            describe, f"doc_id {kind}, digest long, sid binary, n long, bands array<bigint>"
        ),
        "signed",
    )
    texts_of = light.where("n > 0").groupBy("sid", "doc_id", "digest").agg(
        F.count(F.lit(1)).alias("rows"), F.first("n").alias("n")
    )
    heads = saved(
        texts_of.groupBy("sid").agg(
            F.min("doc_id").alias("first_id"),
            F.min(F.struct("doc_id", "digest", "rows")).alias("at"),  # any one text that has the set
            F.sum("rows").alias("copies"),
            F.first("n").alias("n"),
        ),
        "distinct",
    )
    clusters = saved(candidate_clusters(light.where("n > 0")), "clusters")
    # Sets learn their place before their shingles are read, which then move once.
    placed = placements(heads.select("sid", F.col("n").alias("size")), clusters)
    open_sets = saved(heads.join(placed, "sid"), "open")
    n_open = open_sets.count()
    # A text is fetched by id and digest: rows without an id meet their own text only.
    carried = ["n", "copies", "cluster", "blocks"]
    wanted = open_sets.select("at.*", F.col("sid").alias("want"), *carried).withColumnsRenamed(
        {"doc_id": "want_doc", "digest": "want_digest"}
    )
    if n_open <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    same = F.col("doc_id").eqNullSafe(F.col("want_doc")) & (F.xxhash64("text") == F.col("want_digest"))
    texts = docs.select("doc_id", "text").join(wanted, same)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            grams, offsets = distinct_per_row(*words_of(batch.column("text")).grams(size))
            sids, want = sid_column(set_hash(grams, offsets)).to_pylist(), batch.column("want").to_pylist()
            keep = [i for i in range(len(want)) if want[i] == sids[i]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([want[i] for i in keep], pa.binary()),
                    *(batch.column(c).take(pa.array(keep, pa.int64())) for c in carried),
                    pa.array([grams[offsets[i] : offsets[i + 1]].tobytes() for i in keep], pa.binary()),
                ],
                names=["sid", *carried, "grams"],
            )

    # A text that stands in the table once gives its set once; only sets of repeated rows are put together.
    full = [
        texts.where(times)
        .select("want", "text", *carried)
        .mapInArrow(sets_of, "sid binary, n long, copies long, cluster long, blocks long, grams binary")
        for times in ("rows = 1", "rows > 1")
    ]
    sets = full[0].unionByName(full[1].dropDuplicates(["sid"]))
    classes = components(join_placed(sets, n_open, percent).select("a", "b"))
    linked = classes.selectExpr("id AS sid", "component").join(heads.select("sid", "first_id"), "sid")
    first = linked.groupBy("component").agg(F.min("first_id").alias("class_id"))
    keyed = heads.join(linked.select("sid", "component").join(first, "component"), "sid", "left").select(
        "sid", F.coalesce("class_id", "first_id").alias("class_id")
    )
    return light.join(keyed, "sid", "left").select(
        "doc_id",
        "digest",
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.col("n").alias("n_shingles"),
    )


def classed_fingerprints(docs: DataFrame, percent: int = 80, recall: float = 0.999) -> DataFrame:
    """fingerprint_documents with the ``class_id`` of near_duplicate_classes, one row per row."""
    found = _classes(docs, percent, SHINGLE, PERMUTATIONS, recall).where("NOT class_id <=> doc_id")
    other = saved(
        found.select(F.col("doc_id").alias("own"), F.col("digest").alias("own_digest"), "class_id").distinct(),
        "classes",
    )
    if other.count() <= BROADCAST_ROWS:
        other = F.broadcast(other)
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.xxhash64("text") == F.col("own_digest"))
    joined = docs.select("doc_id", "text").join(other, same, "left")
    classed = joined.select(
        "doc_id", "text", F.when(F.col("own_digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )
    return fingerprint_documents(classed, carried=("class_id",))
