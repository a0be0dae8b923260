"""Mixing of sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks, ``BLOCKS`` or as many more as keep the mean block of a table's only
source below ``BLOCK_WORDS`` words, by a hash of doc_id and text, a random permutation of its
documents. A source's target gives its quota: whole passes over all blocks, then blocks in
permuted order up to the target, the last one in part. A binary tree over the output shards
splits the quotas: at each node the left half gets a multivariate hypergeometric draw of its share,
so quotas add up exactly. A shard draws the blocks at the positions the tree gave it, which are
disjoint, and orders what it drew by a hash of its own. There are ``SHARDS`` shards, or one for every
``SHARD_WORDS`` words where these are more.

The tree needs no driver loop: each leaf walks down from the root with generators seeded by the
node, so all leaves see the same draws. What is broadcast are the quotas, one number per source.

Results: null text has size 0. Documents of size 0 belong to their source and are taken as often as
their block. A null source is a source of its own, last in the order. Repeated rows (same doc_id and
text) are documents of their own, taken apart from each other. An empty table gives an empty mix. All columns of ``docs`` are kept; those
named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import bound_batches, saved
from vitalgrid.llm.ngram_join import BROADCAST_ROWS

SALTS = 1024
BLOCKS = 1024
WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
BLOCK_WORDS = 1 << 23
SHARDS = 64
SHARD_WORDS = 1 << 24
MAX_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def targets_of(sizes: list[int], weights: list[float], most: int = MOST_PASSES) -> list[float]:
    """Words each source should give: all words shared by weight, none above ``most`` times its
    size, what is cut off reshared by weight among the others."""
    total = float(sum(sizes))
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = total
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left = total - sum(out[i] for i in range(len(sizes)) if i not in set(open_) - set(over))
        open_ = [i for i in open_ if i not in set(over)]
    return out


def place_of(seed: int) -> Column:
    """The hash that places a row in its source; further copies of a row have places of their own."""
    first = F.xxhash64(F.lit(seed), "doc_id", "text")
    return F.when(F.col("copy_") == 1, first).otherwise(F.xxhash64(F.lit(seed), "doc_id", "text", "copy_"))


def with_copies(docs: DataFrame) -> DataFrame:
    """Rows with ``copy_``: 1, and for rows of one doc_id and text 1, 2 and so on, in any order.

    Only repeated rows are moved. They are numbered in parts of a random salt, whose counts give where
    the numbers of each part begin, so that a row that is most of the table is numbered by many tasks.
    """
    key = F.xxhash64("doc_id", "text")
    again = saved(docs.groupBy(key.alias("key_")).count().where("count > 1").select("key_"), "again")
    n = again.count()
    if not n:
        return docs.withColumn("copy_", F.lit(1).cast("long"))
    keys = F.broadcast(again) if n <= BROADCAST_ROWS else again
    keyed = docs.withColumn("key_", key)
    once = keyed.join(keys, "key_", "left_anti").drop("key_").withColumn("copy_", F.lit(1).cast("long"))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    several = saved(keyed.join(keys, "key_", "left_semi").withColumn("salt_", salt), "several")
    before = Window.partitionBy("key_").orderBy("salt_").rowsBetween(Window.unboundedPreceding, -1)
    counts = several.groupBy("key_", "salt_").count()
    begins = counts.select("key_", "salt_", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin_"))
    number = F.row_number().over(Window.partitionBy("key_", "salt_").orderBy("doc_id"))
    numbered = several.withColumn("number_", number).join(begins, ["key_", "salt_"])
    rows = numbered.select(*docs.columns, (F.col("begin_") + F.col("number_")).cast("long").alias("copy_"))
    return once.unionByName(saved(rows, "copies"))


def blocks_for(words: int) -> int:
    """Blocks of each source of a table of so many words: a power of two."""
    return max(BLOCKS, 1 << (max(1, -(-words // BLOCK_WORDS)) - 1).bit_length())


def shards_for(words: int) -> int:
    return max(SHARDS, -(-words // SHARD_WORDS))


def _described(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, digest, source, size and a hash that places the document in its source."""
    place = place_of(seed)
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("digest"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        place.alias("place"),
    )


def _position(epoch, block, turn, blocks: int):
    """Place of a block in the permuted order of a pass: an affine bijection of block numbers, whose
    multiplier is odd and so has no divisor in common with their power-of-two count."""
    step = F.pmod(F.xxhash64(turn, epoch, F.lit(1)), F.lit(blocks // 2)) * 2 + 1
    shift = F.pmod(F.xxhash64(turn, epoch, F.lit(2)), F.lit(blocks))
    return F.pmod(block * step + shift, F.lit(blocks))


def split_path(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first position, count) of each source in one shard: the walk from the root to its leaf."""
    low, high = 0, shards
    offset, left = np.zeros_like(quotas), quotas.copy()
    while high - low > 1:
        middle = (low + high) // 2
        draw = np.random.default_rng([seed, low, high])
        size = int(left.sum()) * (middle - low) // (high - low)
        part = draw.multivariate_hypergeometric(left, size, method="marginals") if left.any() else left * 0
        if shard < middle:
            left, high = part, middle
        else:
            offset, left, low = offset + part, left - part, middle
    return offset, left


def mix_plan(described: DataFrame, shards: int, seed: int, n_blocks: int) -> tuple[DataFrame, DataFrame]:
    """(block draws, sources). A draw: source, block, epoch, shard; of the block's documents those
    with place up to ``cut``, or the ``only`` one, or all where both are null."""
    spark = described.sparkSession
    blocks = saved(
        described.groupBy("source", "block").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")),
        "blocks",
    )
    per_source = blocks.groupBy("source").agg(F.sum("words").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    ordered = sorted(per_source, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in ordered]
    goal = targets_of(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))])
    rows, kind = [], dict(described.dtypes)["source"]
    for i, r in enumerate(ordered):
        passes = int(goal[i] // sizes[i]) if sizes[i] else 0
        rows.append((r["source"], i, sizes[i], goal[i], passes, goal[i] - passes * sizes[i]))
    schema = f"source {kind}, turn int, source_size long, target double, passes int, rest double"
    sources = spark.createDataFrame(rows, schema)

    # Blocks of the broken last pass, in its order, up to the rest of the target.
    at = _position(F.col("passes"), F.col("block"), F.col("turn"), n_blocks)
    numbered = blocks.join(F.broadcast(sources), blocks["source"].eqNullSafe(sources["source"])).select(
        "turn", "passes", "rest", "block", "words", at.alias("at")
    )
    none = F.lit(-(1 << 63)).cast("long")
    running = Window.partitionBy("turn").orderBy("at")  # one row a block
    upto = numbered.withColumn("upto", F.sum("words").over(running)).withColumn(
        "before", F.col("upto") - F.col("words")
    )
    last = saved(upto.where("before < rest").select("turn", "passes", "rest", "block", "at", "before", "upto"), "last")
    # Only the block the target falls into is cut between documents, below the target; the document
    # whose size is nearest to what is then missing is drawn with it.
    broken = last.where("upto > rest").select("turn", "block", F.col("rest").alias("goal"), "before", "at", "passes")
    inner = Window.partitionBy("turn", "block").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    names = sources.selectExpr("source AS source_name", "turn")
    keyed = described.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("source_name"))).select(
        "turn", "block", "place", "size"
    )
    cuts = saved(
        broken.join(
            keyed.join(F.broadcast(broken), ["turn", "block"])
            .withColumn("reach", F.col("before") + F.sum("size").over(inner))
            .where("reach <= goal")
            .groupBy("turn", "block")
            .agg(F.max("place").alias("cut"), F.max("reach").alias("reach")),
            ["turn", "block"],
            "left",
        ).select(
            "turn", F.col("block").alias("broken"), "passes", F.col("at").alias("broken_at"),
            F.coalesce("cut", none).alias("cut"), (F.col("goal") - F.coalesce("reach", "before")).alias("gap"),
        ),
        "cuts",
    )
    place_at = _position(F.col("passes"), F.col("block"), F.col("turn"), n_blocks)
    untaken = (F.col("at") > F.col("broken_at")) | (
        (F.col("at") == F.col("broken_at")) & (F.col("place") > F.col("cut"))
    )
    extra = (
        keyed.join(F.broadcast(cuts), "turn")
        .withColumn("at", place_at)
        .where(untaken & (F.col("size") < 2 * F.col("gap")))
        .groupBy("turn")
        .agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")), "place", "block")).alias("best"))
        .select("turn", F.col("best.place").alias("only"), F.col("best.block").alias("extra_block"))
    )
    free = F.lit(None).cast("long")
    whole = numbered.where("passes > 0").select(
        "turn", "block", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("epoch"),
        free.alias("cut"), free.alias("only"), F.col("block").alias("home"),
    )
    ended = last.join(cuts.selectExpr("turn", "broken AS block", "cut"), ["turn", "block"], "left").select(
        "turn", "block", F.col("passes").alias("epoch"), "cut", free.alias("only"), F.col("block").alias("home")
    )
    added = cuts.join(extra, "turn").select(
        "turn", F.col("extra_block").alias("block"), F.col("passes").alias("epoch"), free.alias("cut"),
        "only", F.col("broken").alias("home"),
    )
    draws = whole.unionByName(ended).unionByName(added).withColumn(
        "position", F.col("epoch").cast("long") * n_blocks + _position(F.col("epoch"), F.col("home"), F.col("turn"), n_blocks)
    )
    draws = saved(draws, "draws")
    # Blocks without documents hold positions as well; the quota counts positions.
    counts = {r["turn"]: r["n"] for r in last.groupBy("turn").agg((F.max("at") + 1).alias("n")).collect()}
    quotas = np.array([r[4] * n_blocks + counts.get(r[1], 0) for r in rows], dtype=np.int64)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                offset, count = split_path(quotas, shards, shard, seed)
                turn = np.repeat(np.arange(len(quotas)), count)
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(turn.astype(np.int32)),
                        pa.array(offset[turn] + place),
                        pa.array(np.full(len(turn), shard, np.int32)),
                    ],
                    names=["turn", "position", "shard"],
                )

    dealt = spark.range(shards).mapInArrow(leaves, "turn int, position long, shard int")
    drawn = draws.join(dealt, ["turn", "position"]).join(F.broadcast(sources.select("turn", "source")), "turn")
    return drawn.select("turn", "source", "block", "epoch", "shard", "cut", "only"), sources


def mix_sources(docs: DataFrame, shards: int | None = None, seed: int = 7) -> DataFrame:
    """Every document with its source's size and target and ``draws``: the (shard, order, epoch) of
    each time the mix takes it; ``taken`` is its size times their number.

    Reading a shard sorted by ``order`` gives its documents shuffled.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "draws", "place_", "copy_")]
    docs = with_copies(docs.select(*kept))
    described = _described(docs, seed)
    light = saved(described, "sizes")
    words = light.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = blocks_for(words)
    block_of = lambda place: F.pmod(place, F.lit(blocks)).cast("int")
    drawn, sources = mix_plan(light.withColumn("block", block_of(F.col("place"))), shards or shards_for(words), seed, blocks)
    per_block = drawn.groupBy("turn", "block").agg(F.collect_list(F.struct("shard", "epoch", "cut", "only")).alias("plan"))
    place = place_of(seed)
    named = sources.withColumnRenamed("source", "source_name_")
    rows = (
        docs.select(
            *kept,
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            place.alias("place_"),
            block_of(place).alias("block_"),
        )
        .join(F.broadcast(named), F.col("source").eqNullSafe(F.col("source_name_")))
    )
    plan = per_block.withColumnsRenamed({"turn": "turn_", "block": "block_p"})
    plan = F.broadcast(plan) if len(sources.head(MAX_SOURCES)) * blocks <= 1 << 17 else plan
    joined = rows.join(plan, (F.col("turn") == F.col("turn_")) & (F.col("block_") == F.col("block_p")), "left")
    mine = F.filter(
        F.coalesce("plan", F.array().cast("array<struct<shard:int,epoch:int,cut:bigint,only:bigint>>")),
        lambda d: (d["cut"].isNull() | (F.col("place_") <= d["cut"]))
        & (d["only"].isNull() | (F.col("place_") == d["only"])),
    )
    draws = F.transform(
        mine,
        lambda d: F.struct(
            d["shard"].alias("shard"),
            F.xxhash64(d["shard"], d["epoch"], F.col("place_")).alias("order"),
            d["epoch"].alias("epoch"),
        ),
    )
    out = joined.select(*kept, "size", "source_size", "target", draws.alias("draws"))
    return out.withColumn("taken", F.col("size") * F.size("draws"))
