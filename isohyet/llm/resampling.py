"""Importance resampling towards a target distribution of hashed n-grams.

Each document is scanned once: running CRCs at its word edges give the CRC, and so
the bucket, of every n-gram (``prefix_crc``). The buckets are stored; counts per
bucket of the documents and of the target follow from the stored table, and so do
the weights. Documents are drawn without replacement by Gumbel keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, table
from .prefix_crc import ngram_crcs

#: Rows of an Arrow batch, so that a task holds few long texts at a time.
BATCH_ROWS = 64
#: Counts of a partition are given out before they take more than this.
FLUSH_BUCKETS = 1 << 20


def hashed_ngrams(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """``texts(text, ...)`` with n_words and grams in place of text: the bucket of each n-gram, as packed unsigned integers."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")
    others = [c for c in texts.columns if c != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, grams = [], []
            for text in batch.column("text"):
                blocks = list(ngram_blocks(text.as_py() or b""))
                words.append(sum(n for _, n in blocks))
                grams.append(b"".join(g for g, _ in blocks))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(words, pa.int64()), pa.array(grams, pa.binary())], [*others, "n_words", "grams"])

    def ngram_blocks(text: bytes) -> Iterator[tuple[bytes, int]]:
        for crcs, n in ngram_crcs(text, longest):
            yield (crcs % buckets).astype(kind).tobytes(), n

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name != "text"]
    return texts.withColumn("text", F.col("text").cast("binary")).mapInArrow(scan, ", ".join([*fields, "n_words long", "grams binary"]))


def bucket_counts(grams: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all rows of ``grams(grams)``; a task gives one row for each bucket that it has seen."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for g in batch.column(0):
                if g.is_valid:
                    total += np.bincount(np.frombuffer(g.as_buffer(), kind), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    return grams.select("grams").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """For each bucket, a thousand times the log ratio of its smoothed shares in target and source, rounded down."""
    all_s, all_t = sum(source.values()), sum(target.values())
    return np.array(
        [math.floor(1000 * math.log((target.get(b, 0) + 1) * (all_s + buckets) / ((source.get(b, 0) + 1) * (all_t + buckets)))) for b in range(buckets)],
        np.int64,
    )


def weighed(grams: DataFrame, gains: np.ndarray) -> DataFrame:
    """``grams(..., grams)`` with n_features and weight, the mean gain of its features rounded down (none: 0), in place of grams."""
    kind = "<u2" if len(gains) <= 1 << 16 else "<u4"
    others = [c for c in grams.columns if c != "grams"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights = [], []
            for g in batch.column("grams"):
                features = np.frombuffer(g.as_buffer(), kind)
                sizes.append(len(features))
                weights.append(int(gains[features].sum()) // len(features) if len(features) else 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())], [*others, "n_features", "weight"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in grams.schema if f.name != "grams"]
    return grams.mapInArrow(weigh, ", ".join([*fields, "n_features long", "weight long"]))


def resample(
    docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10_000, percent: int = 25, min_words: int = 20, seed: int = 7
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_features, weight, score, rank.

    ``target(text)`` is the text to draw towards. Features are the runs of 1 to
    ``longest`` words, hashed to ``buckets`` (at most 2^20). Of the rows with at least
    ``min_words`` words, ``percent`` in a hundred, rounded down, with the highest
    scores have a rank from 1 on; ties go to the smaller doc_id, null last.
    Null, empty and wordless texts have no features, weight 0, and a score; texts of
    any length are read whole. Rows that repeat a doc_id are each counted and
    ranked, a null doc_id hashes as an empty one. An empty target leaves the smoothed
    shares; empty docs give no rows. Other columns are ignored. The driver holds a
    number per bucket; nothing there grows with the data.
    """
    if not 0 < buckets <= FLUSH_BUCKETS:
        raise ValueError(f"buckets must be from 1 to {FLUSH_BUCKETS}")
    grams = materialise(hashed_ngrams(docs.select("doc_id", "text"), longest, buckets), "grams", BATCH_ROWS)
    counts = [{r["bucket"]: r["n"] for r in bucket_counts(g, buckets).collect()} for g in (grams, hashed_ngrams(target.select("text"), longest, buckets))]
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    key = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    rows = weighed(grams, bucket_gains(*counts, buckets)).withColumn("score", F.col("weight") + key)
    order = [(F.col("n_words") < min_words).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = materialise(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "scored")
    discard(grams)
    # A row for each partition: where its places begin.
    parts = sorted(placed.groupBy("_part").agg(F.count("*").alias("n"), F.count_if(F.col("n_words") >= min_words).alias("able")).collect())
    starts = np.append(0, np.cumsum([r["n"] for r in parts])).tolist()
    begin = F.create_map(*[F.lit(x) for r, at in zip(parts, starts) for x in (r["_part"], at)])[F.col("_part")] if parts else F.lit(0)
    drawn = sum(r["able"] for r in parts) * percent // 100
    place = (F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + begin).cast("long")
    return placed.select("doc_id", "n_features", "weight", "score", F.when(place <= drawn, place).alias("rank"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
