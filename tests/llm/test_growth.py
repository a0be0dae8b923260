"""What follows the size of the table or the place of the archives: shards, blocks, file systems; and SQL."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from vitalgrid.llm import mixing, warc
from vitalgrid.llm.oracles import ORACLES
from vitalgrid.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_shards_and_blocks_grow_with_the_words(spark, monkeypatch):
    assert mixing.shards_for(0) == mixing.SHARDS and mixing.blocks_for(0) == mixing.BLOCKS
    assert mixing.shards_for(100 * mixing.SHARD_WORDS + 1) == 101
    assert mixing.blocks_for(5000 * mixing.BLOCK_WORDS) == 8192
    monkeypatch.setattr(mixing, "SHARD_WORDS", 30)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 2)
    rows = [(i, " ".join(["word"] * (1 + i % 19)), "abc"[i % 3]) for i in range(600)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).cache()
    words = sum(len(t.split()) for _, t, _ in rows)
    shards = mixed.select(F.explode("draws.shard").alias("s")).agg(F.max("s")).first()[0]
    assert mixing.blocks_for(words) > mixing.BLOCKS and mixing.SHARDS < shards < mixing.shards_for(words)
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 19, r
    assert mixed.where("taken > 3 * size").count() == 0


@pytest.mark.parametrize(
    "path, uri",
    [
        ("s3a://bucket/a/b", "s3://bucket/a/b"),
        ("s3n://bucket/a", "s3://bucket/a"),
        ("gs://bucket/a", "gs://bucket/a"),
        ("hdfs://name:8020/a", "hdfs://name:8020/a"),
        ("dbfs:/a/b", "file:///dbfs/a/b"),
        ("file:/a/b", "file:///a/b"),
        ("file:///a/b", "file:///a/b"),
        ("/a/b", "file:///a/b"),
    ],
)
def test_hadoop_paths_as_arrow_names_them(path, uri):
    assert warc.native_uri(path) == uri


def test_archives_through_a_given_file_system(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "u1", "same"), (2, "u2", "same"), (3, None, None)], "page_id long, url string, html string"
    )
    base = str(tmp_path)

    def opened(path: str):
        return fs.SubTreeFileSystem(base, fs.LocalFileSystem()), path.removeprefix("store://")

    manifest = warc.write_archives(pages, "store://archives", opened=opened)
    found = warc.read_archives(spark, f"file://{base}/archives", manifest).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in found} == {
        (1, "revisit", 2), (2, "response", None), (3, "response", None)
    }


@pytest.mark.parametrize("name", ["op5_warc", "op9_ngram_jaccard_join"])
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    assert sorted(rows, key=str) == sorted(want.fetchall(), key=str)
