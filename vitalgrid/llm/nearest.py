"""Approximate nearest neighbours by collision counting over query-centred windows.

Every vector is projected on ``PROJECTIONS`` random lines; a block of vectors keeps one array per
line, sorted by projection. A query looks at the vectors inside a window around its own projection
on each line and counts in how many windows each vector lies. Windows widen by ``GROWTH`` per
round (virtual rehashing: the sorted arrays stay, only the ends move out). Vectors that reach the
collision threshold are verified with the exact measure. The search of a block ends when the k-th
best verified vector is so near that a nearer one would have collided with high probability, or
when all vectors of the block were verified.

The largest inner product becomes the smallest distance by one more component: vectors x are
extended by sqrt(M^2 - |x|^2), M the largest norm, and queries by 0.

Blocks of vectors meet blocks of queries; each such cell returns the k best of its block for each
query, and the best of all blocks are kept. Inside a cell ``TOGETHER`` queries share each round.

Results: vectors that are null, of zero length, or hold null, NaN or infinite components take no
part, neither as query nor as candidate. Vectors of another length than the most common one of the
table raise an error. Ties go to the smaller vec_id. Repeated rows of one vec_id are candidates
each, but not for the query of the same vec_id. Other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


PROJECTIONS = 40
THRESHOLD = 0.6
GROWTH = 1.5
START = 0.35
CERTAINTY = 1.0
SEED = 20
BLOCK = 8192
QUERY_BLOCK = 16384
TOGETHER = 64  # queries that go through the rounds side by side
ROUNDING = 1e-9


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, PROJECTIONS))


class Block:
    """One block of vectors with its sorted projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        gap = np.maximum(largest**2 - (self.vectors**2).sum(axis=1), 0)
        self.lines = directions(vectors.shape[1] + 1)
        extended = np.hstack([self.vectors, np.sqrt(gap)[:, None]])
        self.largest = largest
        projected = extended @ self.lines
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=0).T.copy()
        # Place of each vector on each line: it lies in a window if its place does.
        places = np.arange(len(order)).astype(np.uint16 if len(order) < 1 << 16 else np.uint32)
        self.place = np.empty(self.sorted.shape, places.dtype)
        for j, line in enumerate(order.T):
            self.place[j, line] = places

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the positions and inner products of the k best found, ties to the smaller id.

        The queries go from round to round together, so that windows are found per line for all of them;
        collisions are counted by comparing places, with no copy of what lies inside the windows.
        """
        n, lines = len(self.ids), len(self.sorted)
        at = queries @ self.lines[:-1]
        need = int(np.ceil(THRESHOLD * lines))
        norm2 = (queries**2).sum(axis=1)
        seen = np.zeros((len(queries), n), bool)
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        offset, inside = np.empty_like(self.place), np.empty(self.place.shape, bool)
        going = np.arange(len(queries))
        radius = START * self.largest
        while len(going):
            ends = [(at[going] - radius).T, (at[going] + radius).T]
            low = np.array([np.searchsorted(s, x) for s, x in zip(self.sorted, ends[0], strict=True)])
            high = np.array([np.searchsorted(s, x, side="right") for s, x in zip(self.sorted, ends[1], strict=True)])
            whole = (low == 0).all(axis=0) & (high == n).all(axis=0)
            first, width = low.astype(self.place.dtype), (high - low).astype(self.place.dtype)
            left = []
            for i, q in enumerate(going):
                if whole[i]:
                    fresh = np.flatnonzero(~seen[q])
                else:
                    # Unsigned: a place before the window wraps around to beyond its width.
                    np.subtract(self.place, first[:, i, None], out=offset)
                    np.less(offset, width[:, i, None], out=inside)
                    count = inside.view(np.uint8).sum(axis=0, dtype=np.uint8)
                    fresh = np.flatnonzero((count >= need) & ~seen[q])
                seen[q, fresh] = True
                fresh = fresh[self.ids[fresh] != query_ids[q]]
                if len(fresh):
                    best[q] = self.better(best[q], fresh, queries[q], k)
                score = best[q][1]
                # |q - x|^2 of the extended vectors, at the k-th best.
                near = len(score) == k and max(norm2[q] + self.largest**2 - 2 * score[-1], 0.0) ** 0.5 * CERTAINTY <= radius
                if not (whole[i] or near):
                    left.append(q)
            going = np.array(left, np.int64)
            radius *= GROWTH
        return best

    def better(
        self, best: tuple[np.ndarray, np.ndarray], fresh: np.ndarray, query: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k best of those found before and the fresh ones, by the exact measure."""
        score = np.take(self.vectors, fresh, axis=0) @ query
        if len(fresh) > k:
            # A product of matrices may round equal rows differently; rows this near are measured alike below.
            slack = ROUNDING * self.largest * np.sqrt(query @ query)
            near = score >= np.partition(score, len(score) - k)[len(score) - k] - slack
            fresh = fresh[near]
        found = np.concatenate([best[0], fresh])
        score = np.concatenate([best[1], (self.vectors[fresh] * query).sum(axis=1)])
        keep = np.lexsort((self.ids[found], -score))[:k]
        return found[keep], score[keep]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim).astype(np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    return vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(ok & some)


def nearest_by_inner_product(
    vectors: DataFrame, queries: DataFrame, k: int = 20, block: int = BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k vectors found nearest."""
    base = usable(vectors)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    facts = base.agg(
        F.max(norm).alias("largest"), F.count(F.lit(1)).alias("n"), F.mode(F.size("embedding")).alias("dim"),
        F.min(F.size("embedding")).alias("least"), F.max(F.size("embedding")).alias("most"),
    ).first()
    schema = "query_id long, vec_id long, score double"
    if not facts["n"]:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if facts["least"] != facts["most"]:
        raise ValueError(f"vectors of {facts['least']} to {facts['most']} components in one table")
    dim, largest = facts["dim"], facts["largest"]
    asked = usable(queries)
    n_blocks = -(-facts["n"] // block)
    q_blocks = max(1, -(-asked.count() // query_block))
    sides = base.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("query_block"),
        "vec_id",
        "embedding",
    )
    seekers = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(q_blocks)).cast("int").alias("query_block"),
        "vec_id",
        "embedding",
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            ids = left.column("vec_id").to_numpy()
            index = Block(ids, _matrix(left.column("embedding").combine_chunks(), dim), largest)
            wanted = _matrix(right.column("embedding").combine_chunks(), dim)
            asking = right.column("vec_id").to_numpy()
            for i in range(0, len(wanted), TOGETHER):
                these = asking[i : i + TOGETHER]
                for query_id, (best, score) in zip(these, index.search(these, wanted[i : i + TOGETHER], k), strict=True):
                    out[0].append(np.full(len(best), query_id))
                    out[1].append(index.ids[best])
                    out[2].append(score)
        joined = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table(
            {
                "query_id": pa.array(joined[0].astype(np.int64)),
                "vec_id": pa.array(joined[1].astype(np.int64)),
                "score": pa.array(joined[2].astype(np.float64)),
            }
        )

    found = sides.groupBy("block", "query_block").cogroup(seekers.groupBy("block", "query_block")).applyInArrow(search, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
