"""Benchmark decontamination in DataFrame expressions only.

Texts are reduced to lower-case words. Every run of ``size`` words of a benchmark item is a gram, and
an item of fewer words is one gram. Grams are a broadcast hash set: each document's windows are
hashed in place and looked up without a shuffle, equal hashes are verified word by word, and only
hits leave the scan, as (place, length, items) of a document. Documents holding hits, or just the
words inside hits, can be removed.

A broadcast holds at most ``BLOCK_BYTES`` of grams. A larger benchmark is cut into blocks of grams by
their hash, and the documents are scanned once for each block, so the broadcast has a bound and the
work stays in proportion to documents times blocks.

Results for odd rows. Null counts as a text without words. Texts without words, of documents or
items, hit nothing. Repeated documents each get the same result; documents are told apart by id and
text, so rows of one id with different texts, and rows without an id, are judged each by its text. Repeated items count
once by id; an item without an id marks words and is not counted. Empty tables give no hits. Only
the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.licenses import words_of_text

SIZE = 10
BLOCK_BYTES = 64 << 20  # of gram texts in one broadcast
GRAM_OVERHEAD = 48  # bytes of a hash, a length and array headers beside a gram's text and item ids


def word_array(text: Column) -> Column:
    """Lower-case words of a text; an empty array where it has none."""
    return F.array_remove(F.split(F.trim(words_of_text(text)), " "), "")


def windows(words: Column, size: int) -> Column:
    """Array of (begin, size, hash) of all runs of ``size`` words."""
    last = F.size(words) - size

    def window(i: Column) -> Column:
        run = F.slice(words, i + 1, F.lit(size))
        return F.struct(i.alias("begin"), F.lit(size).alias("size"), F.xxhash64(F.lit(size), run).alias("hash"))

    none = F.array().cast("array<struct<begin:int,size:int,hash:bigint>>")
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window)).otherwise(none)


def benchmark_grams(items: DataFrame, id_col: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(hash, size, gram, items): distinct grams and the ids of the items they stand in."""
    words = items.select(F.col(id_col).alias("item"), word_array(F.col(text)).alias("words")).where("size(words) > 0")
    n = F.least(F.size("words"), F.lit(size)).alias("size")
    grams = words.select("item", "words", n).select(
        "item", "size", F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - F.col("size") + 1),
                lambda i: F.slice("words", i, F.col("size")),
            )
        ).alias("run"),
    )
    return grams.groupBy(F.xxhash64("size", "run").alias("hash"), "size", F.array_join("run", " ").alias("gram")).agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )


def gram_blocks(grams: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """Grams in parts of about ``block_bytes`` each, by hash."""
    weight = F.octet_length("gram") + F.size("items") * 16 + GRAM_OVERHEAD
    total = grams.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    parts = -(-int(total) // block_bytes)
    return [grams.where(F.pmod("hash", F.lit(parts)) == i) for i in range(parts)] if parts > 1 else [grams]


def hits_of_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc, digest, n_rows, n_words, hits, items): one row per distinct document, ``hits`` being the
    distinct (begin, size) of its verified windows and ``items`` the ids of what they stem from."""
    grams = benchmark_grams(items, item_id, item_text, size)
    # At most ``size`` different lengths: short items have windows of their own.
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())
    kind = dict(grams.dtypes)["items"]
    texts = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"), word_array(F.col(text)).alias("words")
    )
    row = F.array(F.struct(F.lit(-1).alias("begin"), F.lit(0).alias("size"), F.lit(0).cast("bigint").alias("hash")))
    found = []
    for at, block in enumerate(gram_blocks(grams, block_bytes)):
        # A place of -1 stands for the document itself and is met once.
        places = F.concat(*([row] if at == 0 else []), *(windows(F.col("words"), n) for n in sizes)) if sizes else row
        placed = texts.select("doc", "digest", "words", places.alias("places"))
        # The lookup is by hash alone; words are put together for equal hashes only.
        known = F.broadcast(block.select(F.col("hash").alias("gram_hash"), "gram", "items"))
        met = placed.select("doc", "digest", "words", F.explode_outer("places").alias("w")).join(
            known, (F.col("w.begin") >= 0) & (F.col("w.hash") == F.col("gram_hash")), "left"
        )
        here = F.array_join(F.slice("words", F.greatest(F.col("w.begin"), F.lit(0)) + 1, F.col("w.size")), " ")
        found.append(
            met.where((F.col("w.begin") < 0) | (F.col("gram").isNotNull() & (here == F.col("gram")))).select(
                "doc",
                "digest",
                F.when(F.col("w.begin") < 0, F.size("words").cast("long")).alias("n_words"),
                F.when(F.col("w.begin") >= 0, F.struct(F.col("w.begin").alias("begin"), F.col("w.size").alias("size"))).alias("hit"),
                "items",
            )
        )
    both = reduce(DataFrame.unionByName, found)
    return both.groupBy("doc", "digest").agg(
        F.count("n_words").alias("n_rows"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).cast(kind).alias("items"),
    )


def covered(hits: Column) -> Column:
    """Sorted places of the words inside hits."""
    places = F.transform(hits, lambda h: F.sequence(h["begin"], h["begin"] + h["size"] - 1))
    return F.array_sort(F.array_distinct(F.flatten(places)))


def spans_of(places: Column) -> Column:
    """(begin, end) of the runs in sorted places."""
    after = F.transform(places, lambda x: x + 1)
    begins, ends = F.array_except(places, after), F.array_except(after, places)
    return F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("begin"), b.alias("end")))


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, contaminated), one row per document row."""
    id_col = options.get("id_col", "doc_id")
    found = hits_of_documents(docs, items, **options)
    counted = found.withColumn("places", covered(F.col("hits"))).select(
        "doc", "n_rows", "n_words", F.size("places").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items", spans_of(F.col("places")).alias("spans"),
    )
    rows = counted.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    return rows.select(
        F.col("doc").alias(id_col), "n_words", "n_hit", "n_items", "items", "spans", (F.col("n_hit") > 0).alias("contaminated")
    )


def remove_contamination(docs: DataFrame, items: DataFrame, spans: bool = False, **options) -> DataFrame:
    """``docs`` without contaminated documents or, with ``spans``, without the words inside hits.

    A removed word goes with the separators before it; the rest of the text stays as it is.
    """
    id_col, text = options.get("id_col", "doc_id"), options.get("text", "text")
    found = hits_of_documents(docs, items, **options).where("size(hits) > 0")
    marked = found.select(F.col("doc").alias("_doc"), F.col("digest").alias("_digest"), covered(F.col("hits")).alias("_places"))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_doc")) & (
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))) == F.col("_digest")
    )
    if not spans:
        return docs.join(marked, same, "left_anti")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    rest = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    pieces = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"({rest}{word})"), F.lit(1))
    tail = F.regexp_extract(F.col(f"`{text}`"), f"({rest})\\z", 1)
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("_pieces") - 1), F.col("_places")), lambda i: F.get("_pieces", i)
    )
    joined = docs.join(marked, same, "left").withColumn("_pieces", F.when(F.col("_places").isNotNull(), pieces))
    cut = F.when(F.col("_places").isNull(), F.col(f"`{text}`")).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.select(*(cut.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
