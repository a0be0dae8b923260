"""Gzip CSV scans with declared schemas, and the ingests built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.sources.registry import SOURCES, Source
from vitalgrid.sources.tables import load_table

# Spellings of a missing number, date or time: fixed values. Text columns know no missing value;
# an empty field is an empty string there.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# Quotes are doubled inside quotes, blanks belong to the value, a row of another width is an error.
FORMAT = {
    "header": "true",
    "inferSchema": "false",
    "enforceSchema": "false",  # every file's header is compared, not only the first one's
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "FAILFAST",
}


def read_csv_gz(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    overrides: Mapping[str, T.DataType] | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Scan headed CSV files into ``schema``, matching columns by header name.

    Files are read as strings under their header and cast, so columns may come in any order and
    extra ones are dropped; all files of one call share a header, another one fails the load. Values that do not fit their
    type fail the load instead of turning into NULL. A gzip file is one task however large it is; ``spread_by``
    spreads its rows right after the scan (with a random salt, so that no key value piles up).
    """
    overrides = overrides or {}
    raw = spark.read.options(**FORMAT).csv(
        list(paths) if isinstance(paths, (list, tuple)) else paths
    )
    present = {c.lower(): c for c in raw.columns}
    columns = []
    for field in schema.fields:
        kind = overrides.get(field.name, field.dataType)
        source = present.get(field.name.lower())
        if source is None:
            raise ValueError(f"column {field.name} is missing from the file header")
        text = F.coalesce(F.col(f"`{source}`"), F.lit(""))
        if not isinstance(kind, T.StringType):
            text = F.when(~text.isin(MISSING), text).cast(kind)
        columns.append(text.alias(field.name))
    rows = raw.select(*columns)
    if spread_by:
        # As many parts of a key as there are partitions: one key may be most of a file.
        salts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
        rows = rows.repartition(F.col(spread_by), (F.rand(7) * salts).cast("int"))
    return rows


def ingest(
    spark: SparkSession,
    source: str | Source,
    root: str,
    database: str | None = None,
    mode: str = "replace",
) -> int:
    """Load one raw table 1:1 into ``database`` (the dataset's name by default); returns its rows.

    Large tables are written sorted by item code inside each file, so that item filters skip row
    groups on later scans.
    """
    s = SOURCES[source] if isinstance(source, str) else source
    rows = read_csv_gz(
        spark, f"{root.rstrip('/')}/{s.path}", s.schema, spread_by=s.key if s.large else None
    )
    if s.large and "itemid" in s.columns:
        rows = rows.sortWithinPartitions("itemid")
    return load_table(spark, rows, database or s.dataset, s.name, mode)


def ingest_all(spark: SparkSession, roots: Mapping[str, str]) -> dict[str, int]:
    """Load every registered table of the datasets named in ``roots`` (dataset -> folder)."""
    return {
        name: ingest(spark, s, roots[s.dataset])
        for name, s in SOURCES.items()
        if s.dataset in roots
    }
