"""Tables as streams, exactly-once sinks and batch equality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.operators.quality import digests, table_diff


def replay_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A Parquet table as an event stream, a bounded number of files per micro-batch.

    ``path`` may be a folder of part files or a single file; a file is streamed as the only match
    in its folder, since a stream source reads folders. A path without any file is an error.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.getFileStatus(place).isFile():
        path, glob = place.getParent().toString(), place.getName()
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob or "*.parquet").load(path)
    if not found.select("path").head(1):
        raise FileNotFoundError(f"no Parquet file to stream in {path}")
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def sink_append(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append a stream to a Parquet folder, each row exactly once.

    The sink's commit log and the checkpoint agree on every batch, so a restarted query neither
    repeats nor drops rows. Readers see committed files only.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_to_table(stream: DataFrame, folder: str) -> DataFrame:
    """Process what is available, stop, and return the sink as a table."""
    query = sink_append(stream, f"{folder}/data", f"{folder}/checkpoint")
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/data")


def checked_against_batch(
    stream: DataFrame, batch: DataFrame, keys: Sequence[str], folder: str
) -> tuple[DataFrame, DataFrame]:
    """Compare a feature stream with its batch form while it runs: (ledger, differences).

    Every micro-batch is held against the batch rows of its keys. The ledger gets its number, its rows,
    an order-free digest of both sides and the number of differing keys; the keys themselves go to the
    differences. Both are written under the batch's number, so a batch that is run again replaces its
    own entry. ``keys`` are unique within a micro-batch, as closed windows are.
    """
    spark, keys = stream.sparkSession, list(keys)
    columns = stream.columns
    found = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields if f.name in keys)

    def check(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        expected = batch.select(*columns).join(rows.select(*keys).distinct(), keys, "left_semi").persist()
        differing = table_diff(expected, rows, keys).persist()
        sides = [
            digests(df, keys, 1).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(f"n_{side}"), F.sum("digest").alias(f"digest_{side}"))
            for df, side in ((expected, "batch"), (rows, "stream"))
        ]
        one = [f.withColumn("batch_id", F.lit(number)) for f in (*sides, differing.agg(F.count(F.lit(1)).alias("n_differing")))]
        entry = one[0].join(one[1], "batch_id").join(one[2], "batch_id")
        entry.write.mode("overwrite").parquet(f"{folder}/ledger/batch={number}")
        differing.select(*keys, "kind", "columns").write.mode("overwrite").parquet(f"{folder}/differences/batch={number}")
        for frame in (differing, expected, rows):
            frame.unpersist()

    writer = stream.writeStream.foreachBatch(check).option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    ledger = spark.read.parquet(f"{folder}/ledger")
    differences = spark.read.schema(f"{found}, kind string, columns string, batch int").parquet(f"{folder}/differences")
    return ledger, differences


def batch_equals_stream(batch: DataFrame, streamed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which a streamed feature differs from its batch form; none when they agree."""
    return table_diff(batch, streamed, keys)
