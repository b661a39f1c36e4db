"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so a document's own MinHash says
little about an item inside it. Instead each item keeps the smallest of its
shingle hashes (a bottom-k MinHash), and documents are probed with all of
theirs: the share of an item's sketch found estimates its containment. Items are
partitioned by size. A small item's sketch is its whole shingle set and the hits
decide exactly; for larger ones a candidate needs so many hits of its sketch
that a contained item fails with no more than the miss probability. Exact
shingle containment verifies every candidate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table
from .near_dedup import shingle_hashes, shingle_set

WIDTH, PERCENT, DEPTH, MISS = 5, 80, 32, 1e-6
#: Bits of the filter that documents are probed with; its size does not grow with the items.
FILTER_BITS = 24
_SHIFTS = (0, 20, 40)
_TO_SPACE = bytes(c if chr(c).isalnum() or c >= 128 or c == 95 else 32 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits, underscores and non-ASCII characters."""
    return text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split() if text else []


def hits_needed(size: int, percent: int = PERCENT, depth: int = DEPTH, miss: float = MISS) -> int:
    """Sketch hits that a candidate needs, by the size of the item.

    Up to ``depth`` shingles the sketch is the set itself. Beyond, hits among
    ``depth`` sampled shingles are at least binomial in the containment.
    """
    if size <= depth:
        return max(1, -(-size * percent // 100))
    p, tail = percent / 100, 0.0
    for need in range(depth + 1):
        tail += math.comb(depth, need) * p**need * (1 - p) ** (depth - need)
        if tail > miss:
            return max(1, need)
    return 1


def item_sketches(items: DataFrame, percent: int, width: int = WIDTH, depth: int = DEPTH, miss: float = MISS) -> DataFrame:
    """``items(item, text)`` to item, words, size, need, sketch; items without words are left out."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in batch.itertuples(index=False):
                words = plain_words(text)
                if words:
                    hashes = shingle_hashes(words, width)
                    rows.append((item, b" ".join(words), len(hashes), hits_needed(len(hashes), percent, depth, miss), hashes[:depth].view(np.int64)))
            yield pd.DataFrame(rows, columns=["item", "words", "size", "need", "sketch"])

    return items.select("item", "text").mapInPandas(sketch, "item long, words binary, size long, need long, sketch array<long>")


def probe_filter(sketches: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of the sketches' hashes, of 2^bits bits, built as bitmaps in Spark."""
    h = sketches.select(F.explode("sketch").alias("h"))
    where = F.explode(F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(F.lit((1 << bits) - 1)) + 1 for s in _SHIFTS]))
    at = h.select(where.alias("v"))
    maps = at.groupBy(F.bitmap_bucket_number("v").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("m")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in maps:
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["m"], np.uint8)
    return out


def probe(docs: DataFrame, bloom: np.ndarray, width: int) -> DataFrame:
    """The documents with a shingle that passes the filter: doc_id, words, hits."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    held, mask = docs.sparkSession.sparkContext.broadcast(bloom), np.uint64(8 * len(bloom) - 1)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            keep, texts, hits = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = plain_words(text)
                found = shingle_hashes(words, width)
                for shift in _SHIFTS:
                    at = (found >> np.uint64(shift)) & mask
                    found = found[(bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                if len(found):
                    keep.append(i)
                    texts.append(b" ".join(words))
                    hits.append(found.view(np.int64))
            arrays = [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(texts, pa.binary()), pa.array(hits, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "words", "hits"])

    return docs.select("doc_id", "text").mapInArrow(test, f"doc_id {doc_id}, words binary, hits array<long>")


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` and item of ``benchmark(item_id, text)`` that it contains.

    Returns doc_id, item_id, item_shingles, found, containment. An item is
    contained where the document has at least ``percent`` in a hundred of its
    distinct shingles of ``width`` words (of fewer words, the whole sequence is
    the one shingle). Case and punctuation do not count. Null, empty and
    wordless texts contain nothing and are contained in nothing. Repeated rows
    of either table give repeated rows; other columns are ignored.
    """
    items = benchmark.select("item_id", "text").withColumn("item", F.monotonically_increasing_id())
    items = materialise(items, "items")
    sketches = materialise(item_sketches(items, percent, width), "sketches")
    candidates = materialise(
        probe(docs, probe_filter(sketches), width).withColumn("row", F.monotonically_increasing_id()), "probed", 500
    )
    index = sketches.select("item", "need", F.explode("sketch").alias("h"))
    pairs = (
        candidates.select("row", F.explode("hits").alias("h"))
        .join(index, "h")
        .groupBy("row", "item", "need")
        .agg(F.count("*").alias("n"))
        .where("n >= need")
        .select("row", "item")
    )
    pairs = materialise(pairs, "candidates")

    @F.pandas_udf("long")
    def common(document: pd.Series, item: pd.Series) -> pd.Series:
        return pd.Series([len(shingle_set(i.split(), width) & shingle_set(d.split(), width)) for d, i in zip(document, item, strict=True)], dtype="int64")

    return (
        pairs.join(candidates.select("row", "doc_id", F.col("words").alias("document")), "row")
        .join(sketches.select("item", "size", F.col("words").alias("item_words")), "item")
        .withColumn("found", common("document", "item_words"))
        .where(F.col("found") * 100 >= F.col("size") * percent)
        .join(items.select("item", "item_id"), "item")
        .select("doc_id", "item_id", F.col("size").alias("item_shingles"), "found", (F.col("found") / F.col("size")).alias("containment"))
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
