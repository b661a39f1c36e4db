"""Suffix-array deduplication of byte windows.

A window of 50 bytes is removed where it also starts in a document with a
smaller doc_id. Windows that can be equal share a winnowed anchor (``anchors``).
Runs of windows with one content are decided by their smallest doc_id
(``repeats``). Where runs with different contents share an anchor, one run of
each goes to the shard of the anchor; the shard sorts its suffixes by induced
sorting, computes permuted common prefixes, and gives each window the smallest
doc_id of its stretch of equal neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import BASE, Spec, covered, mixed
from .common import materialise, ordered_ids, table
from .repeats import SHARD_CONTENTS, distinct_texts, matched_spans, stretches
from .suffix_array import permuted_prefixes, suffix_array

LENGTH, GRAM = 50, 20
#: About the bytes of a shard; sorting takes some hundred times as much memory.
SHARD_BYTES = 1 << 19
NO_ID = (1 << 63) - 1
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_SYMBOLS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def byte_symbols(text: bytes) -> np.ndarray:
    return _SYMBOLS[np.frombuffer(text, np.uint8)]


def byte_spec(length: int, gram: int) -> Spec:
    return Spec(length, gram, bytes, byte_symbols, lambda text, a, b: text[a:b])


def seen_windows(shard: pd.DataFrame, length: int) -> pd.DataFrame:
    """The windows of a shard's pieces that a smaller doc has, from the shard's suffix array: key, doc, first, last."""
    one = shard.drop_duplicates(["c1", "c2"])
    sizes = one["piece"].map(len).to_numpy()
    text = np.frombuffer(b"\0".join(one["piece"]), np.uint8)
    start = np.cumsum(sizes + 1) - sizes - 1
    # A window is valid where it ends within its piece.
    n_windows = sizes - length + 1
    head_of = np.cumsum(n_windows) - n_windows
    within = np.arange(n_windows.sum()) - np.repeat(head_of, n_windows)
    at = np.repeat(start, n_windows) + within
    doc = np.full(len(text), NO_ID)
    doc[at] = np.repeat(one["doc"].to_numpy(), n_windows)
    sa = suffix_array(text)
    joins = permuted_prefixes(text, sa, length)[sa] >= length
    # A window over a piece's end never starts a stretch with a valid one unless its text is the same, so it is cut out.
    head = np.flatnonzero(~joins)
    least = np.repeat(np.minimum.reduceat(doc[sa], head), np.diff(np.append(head, len(sa))))
    found = np.empty(len(text), np.int64)
    found[sa] = least
    first, last = stretches(found[at] < doc[at], head_of)
    piece = np.searchsorted(head_of, first, "right") - 1
    spans = pd.DataFrame({"c1": one["c1"].to_numpy()[piece], "c2": one["c2"].to_numpy()[piece], "a": within[first], "b": within[last]})
    # Rows with the same content and doc have the same verdict.
    rows = shard[["key", "doc", "c1", "c2", "first"]].merge(spans, on=["c1", "c2"])
    return pd.DataFrame({"key": rows["key"], "doc": rows["doc"], "first": rows["first"] + rows["a"], "last": rows["first"] + rows["b"]})


def remove_seen(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_contents: int = SHARD_CONTENTS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removes each byte of the UTF-8 text that is covered by a string of
    ``length`` bytes that also starts in a document with a smaller doc_id, as
    judged on the input. A null text is empty. doc_id is of any type that has an
    order. A null doc_id counts as larger than all others; equal doc_ids never
    remove each other's bytes. An empty table gives an empty result; other
    columns are ignored. Equal texts are told by SHA-256, equal runs by a
    128-bit cryptographic digest, windows of different runs by their bytes.
    """
    spec = byte_spec(length, gram)
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = ordered_ids(docs.select("doc_id", "text"))
    texts = docs.select(body.alias("text"), F.unhex(F.sha2(body, 256)).alias("digest"), F.coalesce("doc", F.lit(NO_ID)).alias("doc"))
    texts = texts.withColumn("key", F.xxhash64("digest"))
    firsts = materialise(texts.groupBy("digest").agg(F.min("doc").alias("first_doc"), F.count("*").alias("n")), "firsts")
    # Of equal texts only that with the smallest doc_id is looked at; the others go as a whole.
    unique = distinct_texts(texts.where(F.octet_length("text") >= length), firsts)
    spans = matched_spans(unique, spec, False, lambda doc, low, n: doc > low, lambda pdf: seen_windows(pdf, length), SHARD_BYTES, shard_contents)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, key, doc, found in zip(batch.column(0).cast(pa.binary()).to_pylist(), *(c.to_pylist() for c in batch.columns[1:]), strict=True):
                gone = covered(np.array([s["first"] for s in found]), np.array([s["last"] + length for s in found]), len(text))
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((key, doc, int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "doc", "cut", "cut_spans", "cut_sha256"])

    done = spans.select("text", "key", "doc", "spans").mapInArrow(cut, "key long, doc long, cut long, cut_spans long, cut_sha256 string")
    done = materialise(done, "cut", 1000)
    rows = docs.select("doc_id", F.coalesce("doc", F.lit(NO_ID)).alias("doc"), F.sha2(body, 256).alias("sha"), F.octet_length(body).cast("long").alias("n_bytes"))
    rows = rows.withColumn("digest", F.unhex("sha")).withColumn("key", F.xxhash64("digest"))
    again = (F.col("doc") > F.col("first_doc")) & (F.col("n_bytes") >= length)
    return (
        rows.join(firsts.drop("n"), "digest")
        .join(done, ["key", "doc"], "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(again, F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
            F.when(again, 1).otherwise(F.coalesce("cut_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(again, EMPTY_SHA).otherwise(F.coalesce("cut_sha256", "sha")).alias("kept_sha256"),
        )
    )


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_seen(table(spark, sf_dir, "documents"))
