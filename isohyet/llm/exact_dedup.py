"""Exact deduplication through an extendible-hash index on shared files.

Native DataFrame operations only. The index is a table of distinct keys (a
64-bit hash of the normalised text) in buckets. A directory over the leading
bits of the keys doubles as long as a bucket is overfull, so a bucket is a key
range of bounded size. The rows of repeated keys go to the task that owns their
bucket, which compares their bytes: rows of one key with equal bytes are a link
of the key's chain, and the owner decides which row of a link stays. A hot key
is cut into slices with owners of their own, whose few results are compared
once more.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, fresh_path, materialise, table

#: What a bucket holds: its repeated texts, and the entry of each key.
BUCKET_BYTES = 16 << 20
SLICE_BYTES = 8 << 20
ENTRY_BYTES = 64
#: Bits that stand for the repeated keys, 8 MB at most.
FILTER_BITS = 1 << 26


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def depth_for(total: int, capacity: int) -> int:
    """Leading bits of a cell: two doublings more than evenly spread keys need."""
    return min(40, math.ceil(math.log2(max(total / capacity, 1))) + 2)


def directory(keys: DataFrame, bucket_keys: int, max_depth: int, weight: Column | None = None) -> DataFrame:
    """The directory over ``keys(key)``: columns cell, depth, bucket.

    A cell is a pattern of ``max_depth`` leading bits. Doubling splits every
    bucket that holds more than ``bucket_keys`` (keys, or units of ``weight``)
    on its next bit, so a cell's depth is the first at which its bucket fits;
    the totals of all depths come from one aggregation. Only a key range that
    ``max_depth`` bits do not tell apart stays overfull.
    """
    weight = F.lit(1) if weight is None else weight
    cell = F.shiftrightunsigned("key", 64 - max_depth).cast("long")
    cells = materialise(keys.groupBy(cell.alias("cell")).agg(F.sum(weight).alias("held")), "cells")
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_depth))))
    levels = levels.withColumn("bucket", F.expr(f"shiftleft(shiftright(cell, {max_depth} - depth), {max_depth} - depth)"))
    totals = levels.groupBy("depth", "bucket").agg(F.sum("held").alias("total"))
    fits = totals.where((F.col("total") <= bucket_keys) | (F.col("depth") == max_depth)).select("depth", "bucket")
    owned = levels.join(fits, ["depth", "bucket"]).groupBy("cell").agg(F.min(F.struct("depth", "bucket")).alias("d"))
    return owned.select("cell", "d.depth", "d.bucket")


def build_index(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The index of ``entries(key, n_bytes)`` on shared files, ordered by key range: bucket, key, n, slices."""
    spark = entries.sparkSession
    keys = materialise(entries.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("n_bytes")), "keys")
    held = F.when(F.col("n") > 1, F.least("n_bytes", F.lit(slice_bytes))).otherwise(0) + ENTRY_BYTES
    depth = depth_for(keys.agg(F.sum(held)).first()[0] or 0, bucket_bytes)
    cells = materialise(directory(keys, bucket_bytes, depth, held), "directory")
    slices = F.when(F.col("n") > 1, F.least("n", F.ceil(F.col("n_bytes") / slice_bytes))).otherwise(1)
    owned = keys.withColumn("cell", F.shiftrightunsigned("key", 64 - depth).cast("long")).join(cells, "cell")
    path = fresh_path(spark, "index")
    owned = owned.select("bucket", "key", "n", F.greatest(slices, F.lit(1)).cast("long").alias("slices"))
    owned.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key").write.parquet(path)
    return spark.read.schema(owned.schema).parquet(path)


def may_repeat(text: DataFrame, repeated: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``text(key, ...)`` whose key may be in ``repeated(key)``.

    A bitmap of fixed size spares the others the shuffle; a full one lets more
    rows through, which the join with the keys themselves then drops.
    """
    bit = F.pmod(F.xxhash64("key"), F.lit(bits)) + 1
    bitmap = repeated.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2)) == 1
    near = text.withColumn("part", F.bitmap_bucket_number(bit)).join(F.broadcast(materialise(bitmap, "bitmap")), "part")  # bits / 8 bytes
    return near.where(held).drop("part", "bitmap")


def decided(docs: DataFrame, index: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """The links of more than one row, by the owners of their buckets: key, digest, keep, group_size.

    Rows get to the owner of their bucket, or of their key's slice, in one
    shuffle and are grouped there by their bytes. Links of a sliced key meet
    again, one row for each slice, and are compared in the same way.
    """
    # A table of their own, whose true size the planner knows: texts that nothing repeats then need no shuffle.
    repeated = materialise(index.where("n > 1").select("bucket", "key", "slices"), "repeated")
    row = F.monotonically_increasing_id()  # spreads rows over slices, even those equal in every column
    text = docs.select("doc_id", F.col("text"), normalised(F.col("text")).alias("body"), row.alias("row")).withColumn("key", key(F.col("body")))
    best = F.struct((-F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("rank"), F.col("doc_id").isNull().alias("no_id"), "doc_id")
    rows = may_repeat(text, repeated).join(repeated, "key").select(
        "bucket", F.pmod(F.xxhash64("row"), "slices").alias("slice"), "slices", "key", "body", best.alias("best")
    )
    links = rows.repartition("bucket", "slice").groupBy("bucket", "slice", "slices", "key", "body")
    links = links.agg(F.min("best").alias("best"), F.count("*").alias("n"))
    links = links.select("bucket", "slices", "key", F.when(F.col("slices") > 1, F.col("body")).alias("body"), F.sha2("body", 256).alias("digest"), "best", "n")
    links = materialise(links, "links")
    sliced = links.where("slices > 1").groupBy("bucket", "key", "body").agg(F.min("digest").alias("digest"), F.min("best").alias("best"), F.sum("n").alias("n"))
    whole = links.where("slices = 1").select("key", "digest", "best", "n").unionByName(sliced.select("key", "digest", "best", "n"))
    return whole.where("n > 1").select("key", "digest", F.col("best.doc_id").alias("keep"), F.col("n").alias("group_size"))


def exact_duplicates(
    docs: DataFrame, key: Callable[[Column], Column] = F.xxhash64, bucket_bytes: int = BUCKET_BYTES, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when they are identical without ASCII white space; a null
    text counts as empty. Of equal texts, the row with the most code points,
    then the smallest doc_id stays. Rows that repeat a doc_id count separately
    in group_size and share its decision. A null doc_id stays only where all
    rows of its group have none; keep_id is then null. An empty table gives an
    empty result. Other columns are ignored. A row looks its link up by key and
    the SHA-256 of its text.
    """
    body = normalised(F.col("text"))
    entries = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), body.alias("body"))
    entries = entries.select("doc_id", "n_chars", F.octet_length("body").cast("long").alias("n_bytes"), key(F.col("body")).alias("key"), F.sha2("body", 256).alias("digest"))
    entries = materialise(entries, "entries")
    groups = decided(docs, build_index(entries, bucket_bytes, slice_bytes), key)
    groups = materialise(groups.withColumn("grouped", F.lit(True)), "groups")
    return entries.join(groups, ["key", "digest"], "left").select(
        "doc_id",
        F.when(F.col("grouped"), F.col("keep")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("grouped"), F.col("doc_id").eqNullSafe(F.col("keep"))).otherwise(F.lit(True)).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "n_chars",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP3_SQL = """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS body
  FROM documents),
g AS (
  SELECT body, count(*) AS group_size, first(doc_id ORDER BY len DESC, doc_id) AS keep_id
  FROM n GROUP BY body)
SELECT n.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       n.doc_id = g.keep_id AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g ON n.body = g.body
"""
