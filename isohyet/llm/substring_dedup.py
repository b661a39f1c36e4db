"""Substring deduplication: seed and extend over words.

Seeds are winnowed anchors that occur again (``anchors``). Runs of windows with
one content match as a whole (``repeats``). Runs that share a seed and differ in
content are joined on it, and the match is extended from the seed both ways, a
word at a time and for all runs of the seed at once: places that agree so far
form a class, and each further word splits it. A window matches where another
place is in its class to the left and to the right. Neighbouring windows that
match join to maximal repeats; those over the threshold length are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import HASH_BITS, Hashed, Powers, Spec, covered
from .common import SPACE, materialise, table, word_count
from .repeats import SHARD_CONTENTS, distinct_texts, matched_spans, stretches

LENGTH, GRAM = 35, 14
SHARD_BYTES = 1 << 22
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def word_symbols(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_spec(length: int, gram: int) -> Spec:
    return Spec(length, gram, bytes.split, word_symbols, lambda words, a, b: b" ".join(words[a:b]))


def refined(classes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Classes split by the given symbols, numbered afresh."""
    return np.unique(classes * (symbols.max(initial=0) + 1) + symbols, return_inverse=True)[1]


def extended(shard: pd.DataFrame, spec: Spec) -> pd.DataFrame:
    """The windows of a shard's pieces that another place has too: key, doc, first, last."""
    length, gram, reach = spec.length, spec.gram, spec.length - spec.gram
    shard = shard.drop_duplicates(["key", "doc", "anchor", "first"])
    split = [spec.units(bytes(x)) for x in shard["piece"]]
    sizes = np.array([len(x) for x in split])
    start = np.cumsum(sizes) - sizes
    words = [w for x in split for w in x]
    number = pd.factorize(np.array(words, object))[0].astype(np.int64)
    # Places of the seeds.
    hashes = np.zeros(len(words), np.uint64)
    grams = Hashed(word_symbols(words), Powers()).grams(gram) & np.uint64((1 << HASH_BITS) - 1)
    hashes[: len(grams)] = grams
    piece = np.repeat(np.arange(len(split)), sizes)
    left_in, right_in = np.arange(len(words)) - start[piece], (start + sizes)[piece] - np.arange(len(words))
    anchor = shard.get("seed", shard["anchor"]).to_numpy()
    seed = np.flatnonzero((hashes == anchor.view(np.uint64)[piece]) & (right_in >= gram))
    lefts, rights = left_in[seed], right_in[seed] - gram
    # Words past an end differ from all others.
    beyond = len(words) + np.arange(len(seed))
    at = lambda p, inside: np.where(inside, number[np.clip(p, 0, len(number) - 1)], beyond)
    here = np.unique(anchor[piece[seed]], return_inverse=True)[1]
    for i in range(gram):
        here = refined(here, number[seed + i])
    right = [here]
    for i in range(reach):
        right.append(refined(right[-1], at(seed + gram + i, rights > i)))
    gone, left = np.zeros(len(words), bool), np.zeros(len(seed), np.int64)
    for o in range(reach + 1):
        # Windows that start o words before their seed.
        fits = np.flatnonzero((lefts >= o) & (rights >= reach - o))
        _, pair, count = np.unique(left[fits] * (len(seed) + 1) + right[reach - o][fits], return_inverse=True, return_counts=True)
        gone[(seed[fits] - o)[count[pair] > 1]] = True
        left = refined(left, at(seed - o - 1, lefts > o))
    first, last = stretches(gone, start)
    p = piece[first]
    origin = shard["first"].to_numpy()[p] - start[p]
    return pd.DataFrame({"key": shard["key"].to_numpy()[p], "doc": shard["doc"].to_numpy()[p], "first": first + origin, "last": last + origin})


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_contents: int = SHARD_CONTENTS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Removes each word that is covered by a window of ``length`` words that also
    starts anywhere else, in the same document or another. Words stand between
    ASCII white space and are compared unchanged; windows are judged on the
    input. kept_text has the kept words joined by one space, kept_sha256 is its
    digest; kept_text is null where no word is removed. A null or empty text
    has no words. Repeated rows repeat each other. An empty table gives an empty
    result; other columns are ignored. Equal texts are told by SHA-256, equal
    runs by a 128-bit cryptographic digest, windows of different runs by their words.
    """
    spec = word_spec(length, gram)
    text = F.coalesce(F.col("text"), F.lit(""))
    # Two hashes of the SHA-256 name a text; of equal texts one stays.
    hashed = docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    hashed = hashed.withColumns({"key": F.xxhash64("digest"), "doc": F.xxhash64("digest", F.lit(1))})
    firsts = materialise(hashed.groupBy("digest").agg(F.min("doc").alias("first_doc"), F.count("*").alias("n")), "firsts")
    unique = distinct_texts(hashed.select("text", "digest", "key", "doc"), firsts)
    spans = matched_spans(unique, spec, True, lambda doc, low, n: n > 1, lambda pdf: extended(pdf, spec), SHARD_BYTES, shard_contents)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, key, doc, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode().split()
                gone = covered(np.array([s["first"] for s in found]), np.array([s["last"] + length for s in found]), len(words))
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
                out.append((key, doc, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "doc", "cut", "cut_sha256", "cut_text"])

    joined = spans.select("text", "key", "doc", "spans")
    found = materialise(joined.mapInArrow(cut, "key long, doc long, cut long, cut_sha256 string, cut_text string"), "cut", 1000)
    plain = F.trim(F.regexp_replace("text", SPACE, " "))
    narrow = hashed.select("doc_id", "key", "doc", "digest", F.sha2(plain, 256).alias("_whole"), word_count(F.col("text")).alias("n_words"))
    copied = (F.col("n") > 1) & (F.col("n_words") >= length)
    return (
        narrow.join(firsts.where("n > 1").select("digest", "n"), "digest", "left")
        .join(found, ["key", "doc"], "left")
        .select(
            "doc_id",
            "n_words",
            F.when(copied, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
            F.when(copied, EMPTY_SHA).otherwise(F.coalesce("cut_sha256", "_whole")).alias("kept_sha256"),
            F.when(copied, "").otherwise(F.col("cut_text")).alias("kept_text"),
        )
    )


def remove_repeats(docs: DataFrame, **how: int) -> DataFrame:
    """The figures of ``without_repeats`` alone."""
    return without_repeats(docs, **how).drop("kept_text")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
