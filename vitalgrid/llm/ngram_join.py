"""Exact Jaccard self-join of documents on word n-grams by prefix trees.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their n-gram sets.

1. Equal sets become one set. A set can only have a partner if, of its first ``2 (n - a)`` grams in
   a global order (``a`` grams must be shared at least), ``n - a`` also occur in another set's such
   prefix; the others leave here, before anything but a third of the gram hashes was shuffled.
2. The rest is ordered by gram frequency. Sets sharing a gram of their rarest-first prefix fall
   into one candidate cluster; no other sets can link.
3. A cluster is cut into blocks of bounded size, and each pair of blocks is joined by a tree: one
   block's sets, commonest grams first, form a prefix tree, which is walked once for all sets of
   the other block; sets sharing a path share its partial overlaps, and a set leaves a subtree when
   the grams left on either side cannot reach the overlap needed.
4. Tasks return spanning links and link counts, not pairs; components of the links give the classes.

Results: null and empty texts have no gram, n_shingles 0 and link with nothing. Texts with fewer
words than ``size`` have the whole sequence as one gram. Repeated rows are texts like any other:
equal sets always link. A row without doc_id takes part; a class consists of the smallest id that
is not null. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import bound_batches, components, saved, text_slices, union_roots
from vitalgrid.llm.shingles import distinct_per_row, set_hash, words_of

SID = np.dtype([("a", ">u8"), ("b", ">u8")])
FLUSH_GRAMS = 600_000
FLUSH_SETS = 60_000
BUCKET_SETS = 4096
BLOCK_SETS = 2048
BLOCK_GRAMS = 2_000_000
BIN_SETS = 512
BROADCAST_ROWS = 1_000_000
CELLS = 16_000_000

PACKED = "bucket int, sids binary, at binary, grams binary"


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Grams a set of ``n`` shares at least with any set it links to."""
    return (percent * n + 99) // 100


def _sets(batch: pa.RecordBatch, size: int):
    words = words_of(batch.column("text"))
    grams, offsets = distinct_per_row(*words.grams(size))
    sids = np.ascontiguousarray(set_hash(grams, offsets).astype(">u8")).view(SID).ravel()
    return grams, offsets, sids


def sid_column(hashes: np.ndarray) -> pa.Array:
    """128-bit hashes, two columns, as a binary column."""
    return _binary(np.ascontiguousarray(hashes.astype(">u8")))


def _binary(sids: np.ndarray) -> pa.Array:
    offsets = np.arange(len(sids) + 1, dtype=np.int32) * 16
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(sids).tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(sids), buffers)


def _sids(column) -> np.ndarray:
    if not len(column):
        return np.zeros(0, SID)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=SID)


def _planes(values: np.ndarray) -> bytes:
    """Sorted 64-bit values with equal bytes side by side, which block compression can use."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64)[:, 0]


class _Packer:
    """Collects (gram, set) and gives them out by bucket of the gram, in bounded portions."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.n, self.sets = buckets, [], 0, 0

    def add(self, grams: np.ndarray, rows: np.ndarray, sids: np.ndarray) -> bool:
        self.parts.append((grams, rows + self.sets, sids))
        self.n += len(grams)
        self.sets += len(sids)
        return self.n >= FLUSH_GRAMS or self.sets >= FLUSH_SETS

    def flush(self) -> pa.RecordBatch | None:
        if not self.n:
            return None
        grams, rows, sids = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.n, self.sets = [], 0, 0
        bucket = (grams & np.uint64(self.buckets - 1)).astype(np.int64)
        order = np.lexsort((grams, bucket))
        grams, rows, bucket = grams[order], rows[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        out = {k: [] for k in ("bucket", "sids", "at", "grams")}
        for a, b in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
            own, at = np.unique(rows[a:b], return_inverse=True)
            out["bucket"].append(int(bucket[a]))
            out["sids"].append(sids[own].tobytes())
            out["at"].append(at.astype(np.uint32).tobytes())
            out["grams"].append(_planes(grams[a:b]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(out["bucket"], pa.int32()),
                *(pa.array(out[k], pa.binary()) for k in ("sids", "at", "grams")),
            ],
            names=list(out),
        )


def _unpack(packed: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sets of a bucket and its distinct (gram, set index), sorted by gram."""
    sids, at, grams, base = [], [], [], 0
    for s, i, g in zip(*(packed.column(k).to_pylist() for k in ("sids", "at", "grams")), strict=True):
        sids.append(np.frombuffer(s, SID))
        at.append(np.frombuffer(i, np.uint32).astype(np.int64) + base)
        grams.append(_unplanes(g))
        base += len(sids[-1])
    own, same = np.unique(np.concatenate(sids), return_inverse=True)
    grams, at = np.concatenate(grams), same[np.concatenate(at)]
    order = np.lexsort((at, grams))
    grams, at = grams[order], at[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (at[1:] != at[:-1])
    return own, grams[keep], at[keep]


def _runs(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of each run of one gram."""
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return first, np.diff(np.concatenate([first, [len(grams)]]))


def describe_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, digest, sid, n_shingles): a hash of each document's text, a 128-bit hash of its gram set
    and the set's size."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            _, offsets, sids = _sets(batch, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), _binary(sids), pa.array(np.diff(offsets), pa.int64())],
                names=["doc_id", "digest", "sid", "n_shingles"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(
        rows, f"doc_id {kind}, digest long, sid binary, n_shingles long"
    )


def _prefixes(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets)
        for batch in text_slices(batches, "text"):
            grams, offsets, sids = _sets(batch, size)
            n = np.diff(offsets)
            spare = n - needed(n, percent)
            length = np.minimum(n, spare + np.maximum(spare, 1))
            row = np.repeat(np.arange(len(n)), length)
            begin = np.cumsum(length) - length
            at = np.repeat(offsets[:-1] - begin, length) + np.arange(length.sum())
            if packer.add(grams[at], row, sids):
                yield packer.flush()
        if (last := packer.flush()) is not None:
            yield last

    return docs.select("text").mapInArrow(rows, PACKED)


def _per_bucket(packed: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return packed.groupBy("bucket").applyInArrow(work, schema)


def _shared_counts(packed: pa.Table) -> pa.Table:
    own, grams, at = _unpack(packed)
    first, length = _runs(grams)
    hits = np.bincount(at[np.repeat(length > 1, length)], minlength=len(own))
    some = hits > 0
    return pa.table({"sid": _binary(own[some]), "shared": pa.array(hits[some], pa.int64())})


def _frequencies(packed: pa.Table) -> pa.Table:
    """Per set of the bucket: its grams that another set has too, and in how many sets each is."""
    own, grams, at = _unpack(packed)
    first, length = _runs(grams)
    many = np.repeat(length > 1, length)
    freq = np.repeat(length, length)[many].astype(np.uint32)
    grams, at = grams[many], at[many]
    order = np.argsort(at, kind="stable")
    grams, freq, at = grams[order], freq[order], at[order]
    ids, begin = np.unique(at, return_index=True)
    edges = np.append(begin, len(at))
    spans = list(zip(edges[:-1], edges[1:], strict=True))
    return pa.table(
        {
            "sid": _binary(own[ids]),
            "grams": pa.array([grams[a:b].tobytes() for a, b in spans], pa.binary()),
            "freq": pa.array([freq[a:b].tobytes() for a, b in spans], pa.binary()),
        }
    )


def _spanning(packed: pa.Table) -> pa.Table:
    """Links between sets that share a gram of the bucket, reduced to one per set."""
    own, grams, at = _unpack(packed)
    first, length = _runs(grams)
    root = union_roots(len(own), np.repeat(at[first], length), at)
    open_ = root != np.arange(len(own))
    return pa.table({"a": _binary(own[root[open_]]), "b": _binary(own[open_])})


def tree_overlaps(
    left: list[np.ndarray], right: list[np.ndarray], n_left: np.ndarray, n_right: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Linking pairs (left index, right index) of sets given as grams sorted by one global order.

    ``n_*`` are the full set sizes; grams that no other set has may be missing from the lists.
    """
    here = np.unique(np.concatenate(left)) if left else np.zeros(0, np.uint64)
    there = np.unique(np.concatenate(right)) if right else here
    vocabulary = np.intersect1d(here, there, assume_unique=True)
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def known(sets):
        out = []
        for s in sets:
            at = np.minimum(np.searchsorted(vocabulary, s), len(vocabulary) - 1)
            out.append(at[vocabulary[at] == s])
        return out

    xs, ys = known(left), known(right)
    # Commonest first, so that sets of one family share long paths.
    count = np.bincount(np.concatenate(ys), minlength=len(vocabulary))
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(vocabulary))
    ys = [np.sort(rank[y]) for y in ys]
    order = sorted(range(len(ys)), key=lambda i: ys[i].astype(">u4").tobytes())
    ys = [ys[i] for i in order]
    order = np.array(order)
    size_y = n_right[order]
    length_y = np.array([len(y) for y in ys])
    found_x, found_y = [], []
    step = max(1, CELLS // len(vocabulary))
    for begin in range(0, len(xs), step):
        part = xs[begin : begin + step]
        has = np.zeros((len(vocabulary), len(part)), np.uint8)
        for i, x in enumerate(part):
            has[rank[x], i] = 1
        size_x = n_left[begin : begin + step]
        left_x = np.array([len(x) for x in part])
        # A node is a range of sorted sets with a common path of ``depth`` grams.
        stack = [(0, len(ys), 0, np.arange(len(part)), np.zeros(len(part), np.int64))]
        while stack:
            lo, hi, depth, live, overlap = stack.pop()
            first, last = ys[lo], ys[hi - 1]
            short = min(len(first), len(last))
            differs = np.flatnonzero(first[depth:short] != last[depth:short])
            until = depth + differs[0] if len(differs) else short
            if until > depth:
                overlap = overlap + has[first[depth:until]][:, live].sum(axis=0, dtype=np.int64)
            # Both unions are at least the larger set: what is left must make up the difference.
            rest = np.minimum(length_y[lo:hi].max() - until, left_x[live] - overlap)
            total = size_x[live] + size_y[lo:hi].min()
            most = overlap + rest
            good = (100 + percent) * most >= percent * total
            live, overlap = live[good], overlap[good]
            if not len(live):
                continue
            if until == short and hi - lo > 1 and len(last) == len(first) == until or hi - lo == 1:
                whole = (100 + percent) * overlap[:, None] >= percent * (
                    size_x[live][:, None] + size_y[lo:hi][None, :]
                )
                i, j = np.nonzero(whole)
                found_x.append(live[i] + begin)
                found_y.append(order[lo + j])
                continue
            at = lo
            while at < hi:
                end = at + 1
                if len(ys[at]) > until:
                    head = ys[at][until]
                    low, high = at + 1, hi
                    while low < high:  # last set of the range that goes on with the same gram
                        mid = (low + high) // 2
                        if len(ys[mid]) > until and ys[mid][until] == head:
                            low = mid + 1
                        else:
                            high = mid
                    end = low
                else:
                    while end < hi and len(ys[end]) == until:
                        end += 1
                stack.append((at, end, until, live, overlap))
                at = end
    if not found_x:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_x), np.concatenate(found_y)


def _join_blocks(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Join the block pairs of one bin; rows carry cluster, own block and the pair they stand for."""

    def work(rows: pa.Table) -> pa.Table:
        sids = _sids(rows.column("sid"))
        n = rows.column("n").to_numpy()
        copies = rows.column("copies").to_numpy()
        grams = [np.frombuffer(g, np.uint64) for g in rows.column("grams").to_pylist()]
        keys = rows.column("cluster").to_numpy()
        low, high, own = (rows.column(k).to_numpy() for k in ("low", "high", "block"))
        order = np.lexsort((sids["b"], sids["a"], own, high, low, keys))
        cuts = np.flatnonzero(
            (np.diff(keys[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        )
        a, b, links = [], [], np.zeros(len(sids), np.int64)
        for part in np.split(order, cuts + 1):
            fresh = np.ones(len(part), bool)
            fresh[1:] = sids[part][1:] != sids[part][:-1]  # one row per set
            part = part[fresh]
            same = low[part[0]] == high[part[0]]
            xs = part if same else part[own[part] == low[part]]
            ys = part if same else part[own[part] == high[part]]
            if not len(xs) or not len(ys):
                continue
            i, j = tree_overlaps([grams[k] for k in xs], [grams[k] for k in ys], n[xs], n[ys], percent)
            x, y = xs[i], ys[j]
            x, y = x[x != y], y[x != y]
            np.add.at(links, x, copies[y])
            if not same:
                np.add.at(links, y, copies[x])
            local = np.searchsorted(np.sort(part), x), np.searchsorted(np.sort(part), y)
            root = union_roots(len(part), *local)
            members = np.sort(part)
            a.append(members[root])
            b.append(members)
        if not a:
            return pa.table({"a": _binary(sids[:0]), "b": _binary(sids[:0]), "links": pa.array([], pa.int64())})
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.table({"a": _binary(sids[a]), "b": _binary(sids[b]), "links": pa.array(links[b], pa.int64())})

    return work


def ngram_classes(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, the row's own included; ``n_links``
    counts the other rows it links to directly.
    """
    return classed_rows(docs, size, percent).select("doc_id", "n_shingles", "component_id", "n_links")


def classed_rows(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """``ngram_classes`` with the ``digest`` of each row's text and ``class``, which tells components
    apart also where none of their rows has an id."""
    bound_batches(docs.sparkSession)
    light = saved(describe_sets(docs, size), "sets")
    total = light.count()
    buckets = 1 << max(6, (max(total, 1) // BUCKET_SETS).bit_length())
    sets = saved(
        light.where("n_shingles > 0")
        .groupBy("sid")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min(F.struct("doc_id", "digest")).alias("at"),  # any one row that has the set
            F.first("n_shingles").alias("n"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "distinct",
    )
    shared = (
        _per_bucket(_prefixes(docs, size, percent, buckets), _shared_counts, "sid binary, shared long")
        .groupBy("sid")
        .agg(F.sum("shared").alias("shared"))
    )
    spare = F.expr(f"n - (n * {percent} + 99) div 100")
    open_sets = saved(
        sets.join(shared, "sid").where(F.col("shared") >= F.greatest(spare, F.lit(1))).select(
            "sid", "n", "copies", "first_id", "at"
        ),
        "open",
    )
    found = _links(docs, open_sets, size, percent)
    classes = found.groupBy("component").agg(F.min("first_id").alias("class_id"))
    linked = found.join(classes, "component").select("sid", "component", "class_id", "links")
    keyed = sets.join(linked, "sid", "left").select(
        "sid",
        F.coalesce("component", "sid").alias("class"),
        F.coalesce("class_id", "first_id").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return light.join(keyed, "sid", "left").select(
        "doc_id",
        "digest",
        "class",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def _links(docs: DataFrame, open_sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(sid, component, links, first_id) for the sets of ``open_sets`` that link to another one."""
    count = open_sets.count()
    buckets = 1 << max(6, (max(count, 1) // BUCKET_SETS).bit_length())
    # A text is fetched by id and digest: rows without an id meet their own text only.
    wanted = open_sets.select(F.col("at.doc_id").alias("doc_id"), F.col("at.digest").alias("digest"), F.col("sid").alias("want"))
    if count <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.xxhash64("d.text") == F.col("w.digest"))
    texts = docs.select("doc_id", "text").alias("d").join(wanted.alias("w"), same).select("want", "text")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            grams, offsets, sids = _sets(batch, size)
            want = batch.column("want").to_pylist()
            keep = [i for i in range(len(want)) if want[i] == sids[i].tobytes()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([want[i] for i in keep], pa.binary()),
                    pa.array([grams[offsets[i] : offsets[i + 1]].tobytes() for i in keep], pa.binary()),
                ],
                names=["sid", "grams"],
            )

    # Rows repeated in the table give their set again.
    full = saved(texts.mapInArrow(sets_of, "sid binary, grams binary").dropDuplicates(["sid"]), "full")

    def packed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets)
        for batch in batches:
            for sid, grams in zip(*(batch.column(k).to_pylist() for k in ("sid", "grams")), strict=True):
                values = np.frombuffer(grams, np.uint64)
                if packer.add(values, np.zeros(len(values), np.int64), np.frombuffer(sid, SID)):
                    yield packer.flush()
        if (last := packer.flush()) is not None:
            yield last

    parts = _per_bucket(
        full.mapInArrow(packed_sets, PACKED), _frequencies, "sid binary, grams binary, freq binary"
    )
    gathered = (
        parts.groupBy("sid")
        .agg(F.collect_list(F.struct("grams", "freq")).alias("parts"))
        .join(open_sets.select("sid", "n", "copies"), "sid")
    )

    def ordered_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                grams = np.concatenate([np.frombuffer(p["grams"], np.uint64) for p in parts])
                freq = np.concatenate([np.frombuffer(p["freq"], np.uint32) for p in parts])
                out.append(grams[np.lexsort((grams, freq))].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("sid"), batch.column("n"), batch.column("copies"),
                    pa.array(out, pa.binary()),
                ],
                names=["sid", "n", "copies", "grams"],
            )

    ordered = saved(
        gathered.select("sid", "n", "copies", "parts").mapInArrow(
            ordered_sets, "sid binary, n long, copies long, grams binary"
        ),
        "ordered",
    )

    def rare_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets)
        for batch in batches:
            for sid, n, grams in zip(
                *(batch.column(k).to_pylist() for k in ("sid", "n", "grams")), strict=True
            ):
                grams = np.frombuffer(grams, np.uint64)
                alone = n - len(grams)  # grams of this set only come first in the order
                length = max(0, n - (percent * n + 99) // 100 + 1 - alone)
                head = grams[:length]
                if packer.add(head, np.zeros(len(head), np.int64), np.frombuffer(sid, SID)):
                    yield packer.flush()
        if (last := packer.flush()) is not None:
            yield last

    near = _per_bucket(
        ordered.select("sid", "n", "grams").mapInArrow(rare_prefixes, PACKED), _spanning, "a binary, b binary"
    )
    joined = join_clusters(ordered, components(near), percent)
    links = joined.groupBy(F.col("b").alias("sid")).agg(F.sum("links").alias("links"))
    labels = components(joined.select("a", "b"))
    return (
        labels.selectExpr("id AS sid", "component")
        .join(links, "sid")
        .join(open_sets.select("sid", "first_id"), "sid")
    )


def placements(sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """(sid, cluster, blocks) of the sets (sid, size) that stand in one of ``clusters`` (id, component):
    how many blocks a cluster of so many sets and grams is cut into. Only narrow rows are moved. Clusters
    go by 64 bits; two of equal bits are joined as one, which adds no link."""
    placed = sets.join(clusters.selectExpr("id AS sid", "xxhash64(component) AS cluster"), "sid")
    weight = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_GRAMS))
    return placed.select("sid", "cluster").join(placed.groupBy("cluster").agg(weight.alias("blocks")), "cluster")


def join_clusters(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """join_placed for sets (sid, n, copies, grams) that do not know their cluster (id, component) yet."""
    sized = sets.select("sid", (F.length("grams") / 8).alias("size"))
    placed = saved(placements(sized, clusters), "placed")
    return join_placed(sets.join(placed, "sid"), placed.count(), percent)


def join_placed(sets: DataFrame, count: int, percent: int) -> DataFrame:
    """All links between the ``count`` sets (sid, n, copies, grams, cluster, blocks) of one cluster, as a
    stored table: (a, b) spans what each task found, ``links`` adds up to the links of set b.

    A large cluster is cut into blocks, and each pair of blocks is a group of its own; small
    clusters share groups. What meets in a group is bounded by the block size.
    """
    bins = max(64, count // BIN_SETS)
    dealt = (
        sets.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .withColumn(
            "bin",
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(
                F.xxhash64("cluster", "low", "high")
            ),
        )
        .select("bin", "cluster", "block", "low", "high", "sid", "n", "copies", "grams")
    )
    work = _join_blocks(percent)
    return saved(dealt.groupBy("bin").applyInArrow(work, "a binary, b binary, links long"), "links")
