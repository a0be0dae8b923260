"""Data-quality rules. A rule is a DataFrame of violating rows; no rows means it holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(columns: Sequence[str]) -> Column:
    """True where one of the columns is NULL."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def outside(
    column: str, values: Sequence | None = None, low: float | None = None, high: float | None = None
) -> Column:
    """True outside a value list or a closed range. NULL is left to ``missing``."""
    bad = F.lit(False)
    if values is not None:
        bad = bad | ~F.col(column).isin(list(values))
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return bad


def broken(condition: Column) -> Column:
    """True where a rule of its own does not hold; an undecided rule counts as broken."""
    return ~F.coalesce(condition, F.lit(False))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(missing(columns))


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their count. Counted before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def relationships(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None):
    """Child rows whose key is present and has no parent."""
    parents = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(parents, key, "left_anti")


def accepted(
    df: DataFrame,
    column: str,
    values: Sequence | None = None,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Rows outside a value list or a closed range. NULL is left to ``not_null``."""
    return df.where(outside(column, values, low, high))


def violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a rule of its own does not hold."""
    return df.where(broken(condition))


def rule_counts(rules: Mapping[str, DataFrame]) -> DataFrame:
    """Violating rows per rule, zero included."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit(name).alias("rule"), "n_bad")
        for name, df in rules.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def row_rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violating rows per rule on single rows of one table, zero included, all in one pass."""
    counts = df.agg(
        *[
            F.struct(F.lit(name).alias("rule"), F.count_if(bad).alias("n_bad")).alias(f"_{i}")
            for i, (name, bad) in enumerate(rules.items())
        ]
    )
    return counts.select(F.inline(F.array(*[f"_{i}" for i in range(len(rules))])))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, missing values, smallest and largest value (as text) per column, in one pass."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("n_rows"),
                (F.count(F.lit(1)) - F.count(c)).alias("n_null"),
                F.min(c).cast("string").alias("lowest"),
                F.max(c).cast("string").alias("highest"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(
        F.explode(F.array(*[f"_{i}" for i in range(len(columns))])).alias("s")
    ).select("s.*")


BUCKETS = 4096


def digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, digest): rows and an order-free digest of them per bucket of keys.

    Equal multisets of rows have equal digests; missing values and the columns' order of values count.
    """
    row = F.xxhash64(*[F.struct(F.col(c).isNull().alias("m"), F.col(c).alias("v")) for c in df.columns])
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(20,0)")).alias("digest")
    )


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def table_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys whose rows differ between two tables: (keys, kind, columns).

    Rows are compared as multisets, so a repeated row counts, and missing keys and values equal each
    other: a table never differs from itself. ``kind`` says whether the surplus rows of a key are
    ``only in first``, ``only in second`` or on both sides (``changed``, with the columns whose values
    differ). Buckets of keys with equal digests are left out before any row is moved.
    """
    keys, b = list(keys), b.select(*a.columns)
    columns = [c for c in a.columns if c not in keys]
    left, right = (digests(df, keys, buckets) for df in (a, b))
    same = left.join(right.withColumnsRenamed({"n": "n2", "digest": "d2"}), "bucket", "full")
    equal = F.col("n").eqNullSafe(F.col("n2")) & F.col("digest").eqNullSafe(F.col("d2"))
    unequal = F.broadcast(same.where(~equal).select("bucket"))  # at most one row per bucket
    signed = [
        df.withColumn("bucket", _bucket(keys, buckets)).join(unequal, "bucket", "left_semi").drop("bucket").withColumn("_n", F.lit(n))
        for df, n in ((a, 1), (b, -1))
    ]
    surplus = signed[0].unionByName(signed[1]).groupBy(*a.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")

    def value(c: str) -> Column:
        return F.xxhash64(F.col(c).isNull(), F.col(c)).cast("decimal(20,0)") * F.col("_n")

    per_key = surplus.groupBy(*keys).agg(
        F.max("_n").alias("_most"),
        F.min("_n").alias("_least"),
        *[(F.sum(value(c)) != 0).alias(f"_differs_{i}") for i, c in enumerate(columns)],
    )
    differing = F.filter(
        F.array(*[F.when(F.col(f"_differs_{i}"), F.lit(c)) for i, c in enumerate(columns)]).cast("array<string>"), lambda x: x.isNotNull()
    )
    return per_key.select(
        *keys,
        F.when(F.col("_least") > 0, "only in first").when(F.col("_most") < 0, "only in second").otherwise("changed").alias("kind"),
        F.when((F.col("_least") < 0) & (F.col("_most") > 0), F.concat_ws(",", differing)).alias("columns"),
    )
