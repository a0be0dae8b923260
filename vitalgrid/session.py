"""Session contract: the SQL settings every plan in this package relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Results depend on these.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Plans rely on these: sizes are decided from run-time statistics, and skewed join partitions are
# always split.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


# Below this a side is broadcast: as Spark guesses its size before it runs, and as it measured it.
GUESSED = "spark.sql.autoBroadcastJoinThreshold"
MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"

# The same for plans that join many sides at once, and the session's own limit while this one is set.
MANY_SIDES = 1024 * 1024
OWN = "spark.vitalgrid.ownBroadcastThreshold"


def apply_contract(spark: SparkSession) -> SparkSession:
    """Set the run-time settings on a session made elsewhere; sizes and memory stay as they are."""
    for key, value in {**SEMANTICS, **ADAPTIVE}.items():
        spark.conf.set(key, value)
    return own_broadcasts(broadcast_as_measured(spark))


def broadcast_as_measured(spark: SparkSession) -> SparkSession:
    """Keep the session's broadcast threshold, but for sides Spark has measured only.

    A guess starts from compressed files and does not see what ``explode`` adds: intervals listed by
    block were guessed small and took more than the driver holds.
    """
    limit = spark.conf.get(GUESSED)
    if limit.rstrip("b") != "-1":
        if spark.conf.get(MEASURED, None) is None:
            spark.conf.set(MEASURED, limit)
        spark.conf.set(GUESSED, "-1")
    return spark


def small_broadcasts(spark: SparkSession) -> SparkSession:
    """Lower the session's broadcast threshold to MANY_SIDES until ``own_broadcasts`` is called.

    The driver collects, builds and serves every broadcast side, and a plan of many joins does so for
    several at once: each side may be below the threshold and their sum beyond the driver.
    """
    broadcast_as_measured(spark)
    own = spark.conf.get(MEASURED, None)
    if own is not None and bytes_of(own) > MANY_SIDES:
        spark.conf.set(OWN, own)
        spark.conf.set(MEASURED, f"{MANY_SIDES}b")
    return spark


def own_broadcasts(spark: SparkSession) -> SparkSession:
    """Give a session its own broadcast threshold back."""
    own = spark.conf.get(OWN, None)
    if own is not None:
        spark.conf.set(MEASURED, own)
        spark.conf.unset(OWN)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Run-time settings for the while of some work."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def freed_shuffles(spark: SparkSession):
    """Each job that ends meanwhile gives its shuffle files back at once.

    Spark frees them when the driver collects garbage, and a driver with memory to spare does so late:
    files of models that are long stored add up beside those of the last one. Only for frames that are
    run once, as those are that are written: another run would make them again.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def bytes_of(size: str) -> int:
    """A size as Spark's settings write it: 10485760b, 256k, 10MB."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Partitions that keep one shuffle task near 128 MB, never fewer than the cores."""
    return max(cores, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    master: str,
    app: str = "vitalgrid",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for local runs and tests."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        **SEMANTICS,
        **ADAPTIVE,
        **(extra or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return broadcast_as_measured(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path in the cluster's shared folder; a local folder only where none is named and driver
    and executors are one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="vitalgrid-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
