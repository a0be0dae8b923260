"""Token usage logs: reading JSON lines, removing repeats, costs per model, scope and session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.operators.ranking import top1

# Cache prices as multiples of the input price: fixed values.
CACHE_READ = 0.1
CACHE_WRITE_SHORT = 1.25
CACHE_WRITE_LONG = 2.0
SYNTHETIC = "<synthetic>"

RANK_BUCKETS = 256

AXES = ["input", "output", "cache_write_1h", "cache_write_5m", "cache_read"]

_LINE = (
    "requestId string, message struct<model: string, usage: struct<input_tokens: bigint, "
    "output_tokens: bigint, cache_creation_input_tokens: bigint, cache_read_input_tokens: bigint, "
    "cache_creation: struct<ephemeral_1h_input_tokens: bigint, ephemeral_5m_input_tokens: "
    "bigint>>>"
)


def read_usage_lines(spark: SparkSession, root: str, glob: str = "*.jsonl") -> DataFrame:
    """All lines of ``glob`` files below a folder, malformed ones included, with where they came from.

    A file directly in the folder is a session of its own; deeper files belong to the session
    named by the first folder on their path. ``line_order`` follows file names, then lines.
    """
    text = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(root)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                # Increases along one file block, which one task reads in order.
                F.monotonically_increasing_id().alias("line"),
            ).alias("line_order"),
        )
        .where(F.trim("value") != "")
    )
    marker = root.rstrip("/").rsplit("/", 1)[-1] + "/"
    below = F.split(F.substring_index(F.col("file"), "/" + marker, -1), "/")
    return text.select(
        F.from_json("value", _LINE).alias("entry"),
        F.try_parse_json("value").isNull().alias("malformed"),
        "line_order",
        F.regexp_replace(below[0], r"\.jsonl$", "").alias("session"),
        (F.size(below) > 1).alias("nested"),
    )


def malformed_lines(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count_if("malformed").alias("n_malformed"))


def usage_records(lines: DataFrame) -> DataFrame:
    """Normal form of usage lines. A cache write without lifetimes counts as the long one."""
    usage = F.col("entry.message.usage")

    def tokens(name: str) -> Column:
        return F.coalesce(usage.getField(name), F.lit(0))

    long_ = F.coalesce(F.col("entry.message.usage.cache_creation.ephemeral_1h_input_tokens"), F.lit(0))
    short = F.coalesce(F.col("entry.message.usage.cache_creation.ephemeral_5m_input_tokens"), F.lit(0))
    unsplit = (long_ + short == 0) & (tokens("cache_creation_input_tokens") > 0)
    return lines.where(usage.isNotNull()).select(
        F.col("entry.requestId").alias("request_id"),
        "line_order",
        "session",
        F.when(F.col("nested"), "sub").otherwise("main").alias("scope"),
        F.coalesce(F.col("entry.message.model"), F.lit("unknown")).alias("model"),
        tokens("input_tokens").alias("input"),
        tokens("output_tokens").alias("output"),
        F.when(unsplit, tokens("cache_creation_input_tokens"))
        .otherwise(long_)
        .alias("cache_write_1h"),
        short.alias("cache_write_5m"),
        tokens("cache_read_input_tokens").alias("cache_read"),
    )


def first_per_request(records: DataFrame) -> DataFrame:
    """The first line of each request; lines without a request id are all kept."""
    named = top1(
        records.where(F.col("request_id").isNotNull()), ["request_id"], [F.col("line_order")]
    )
    return named.unionByName(records.where(F.col("request_id").isNull()))


def usage_rollup(records: DataFrame, prices: DataFrame, top: int = 10) -> DataFrame:
    """Totals per model, per scope and for the ``top`` dearest sessions.

    ``prices`` (model, input_price, output_price per million tokens) is a price list; Spark
    broadcasts it when it measures it small. A model without a price costs NULL, never 0; totals
    per scope and session add up what is priced. Costs are summed as decimals.
    """
    exact = "decimal(12,4)"
    inp, outp = F.col("input_price").cast(exact), F.col("output_price").cast(exact)
    weighted = (
        F.col("input") * inp
        + F.col("output") * outp
        + F.col("cache_write_1h") * (inp * F.lit(CACHE_WRITE_LONG).cast("decimal(4,2)"))
        + F.col("cache_write_5m") * (inp * F.lit(CACHE_WRITE_SHORT).cast("decimal(4,2)"))
        + F.col("cache_read") * (inp * F.lit(CACHE_READ).cast("decimal(4,2)"))
    ).cast("decimal(28,6)")
    costed = (
        first_per_request(records)
        .where(F.col("model") != SYNTHETIC)
        .join(prices, "model", "left")
        .withColumn("_cost", weighted)
    )
    # One pass: every record is counted once per dimension.
    dimensions = F.explode(
        F.array(
            *[
                F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("name"))
                for d in ("model", "scope", "session")
            ]
        )
    )
    totals = (
        costed.select("*", dimensions.alias("_d"))
        .groupBy("_d.dimension", "_d.name")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            *[F.sum(a).alias(a) for a in AXES],
            (F.sum("_cost").cast("double") / 1_000_000).alias("cost"),
        )
    )
    # Sessions are ranked in buckets of names first, so that no task sorts all of them.
    dearest = [F.col("cost").desc_nulls_last(), F.col("name")]
    kept = (F.col("dimension") != "session") | (F.col("_rank") <= top)
    bucket = F.pmod(F.xxhash64("name"), F.lit(RANK_BUCKETS))
    columns = totals.columns
    for within in (["dimension", bucket], ["dimension"]):
        ranked = F.row_number().over(Window.partitionBy(*within).orderBy(*dearest))
        totals = totals.withColumn("_rank", ranked).where(kept).select(*columns)
    return totals
