"""A corpus pipeline of five stages; each works on all rows its predecessor kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of
``documents``. Rows with nulls and empty texts pass every filter: they are neither toxic nor copies.
Of rows that repeat id and text one stays if the text has words. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm import byte_bpe, toxicity
from vitalgrid.llm.common import saved, table
from vitalgrid.llm.mixing import mix_sources
from vitalgrid.llm.ngram_join import BROADCAST_ROWS, classed_rows
from vitalgrid.llm.passages import remove_repeats


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model is fitted on the labelled ones outside its test fold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by n-gram overlap the one of the smallest doc_id stays (a missing one is smallest;
    then the smallest text digest), once. Rows without words are linked with nothing and all stay."""
    rows = saved(classed_rows(docs).where("n_shingles > 0").groupBy("class", "doc_id", "digest").count(), "classes")
    first = rows.groupBy("class").agg(F.min(F.struct("doc_id", "digest")).alias("kept")).select("kept.*")
    others = rows.select("doc_id", "digest").alias("r").join(
        first.alias("f"), _same("r.doc_id", "f.doc_id") & (F.col("r.digest") == F.col("f.digest")), "left_anti"
    )
    gone = saved(others, "gone")
    left = _with_digest(docs, gone, "left_anti")
    # Rows of one id and text that stand in the table several times: only they are put together.
    again = saved(rows.where("count > 1").select("doc_id", "digest"), "again")
    once = _with_digest(left, again, "left_anti")
    several = _with_digest(left, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(several).select(*docs.columns) if again.head(1) else left.select(*docs.columns)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _with_digest(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` that have, or have not, an (id, digest of the text) among ``keys``."""
    keys = keys.withColumnsRenamed({"doc_id": "key_id", "digest": "key_digest"})
    same = _same("doc_id", "key_id") & (F.xxhash64("text") == F.col("key_digest"))
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, same, how)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that earlier documents have are cut out of the text; n_chars follows."""
    shorter = remove_repeats(docs).select(*docs.columns)
    return shorter.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time the mix takes a document, in the shuffled order of the mix's shards."""
    taken = mix_sources(docs).select(*docs.columns, F.explode("draws").alias("draw"))
    dealt = taken.repartition("draw.shard").sortWithinPartitions("draw.shard", "draw.order", "draw.epoch")
    return dealt.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every row."""
    return byte_bpe.encode_rows(docs, digests=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", keep_one_of_each_class),
    ("substring_dedup", cut_passages),
    ("mixing", mix),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
