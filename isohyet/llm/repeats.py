"""What the byte-wise and the word-wise substring deduplication share.

Of equal texts one stays; the runs of its recurring anchors (``anchors``) are
grouped by content. A run whose content decides it goes as a whole. Runs that
share an anchor and differ in content meet in shards, which the caller decides
window by window. An anchor with more contents than a shard holds is split: its
windows are named by several of their smallest gram hashes instead of one, runs
of one name are judged like those of an anchor, and so on until all grams of a
window are its name. So no anchor lands in one task, and the caller decides all
that differs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import Spec, bit_filter, deeper_runs, key_bits, passing, recurring, recurring_runs
from .common import discard, materialise

#: Contents of one anchor in a shard, and symbols for each of them.
SHARD_CONTENTS, CONTENT_SYMBOLS = 8192, 128
#: How anchors with more are split: gram hashes in a name, and windows in a run. The last has all grams of any window.
DEPTHS = ((4, 1 << 12), (12, 1 << 8), (1 << 10, 1 << 6))
#: Anchors are judged a slice at a time, which bounds the shuffle files that are there at once.
SLICES = 4
_KEYS = ["key", "doc"]


def maybe_in(keys: DataFrame, column: Column) -> Column:
    """Whether ``column`` may be one of ``keys(key)``, by a filter of fixed size: it is always true of those that are."""
    held = keys.sparkSession.sparkContext.broadcast(bit_filter(key_bits(keys)))

    @F.pandas_udf("boolean")
    def found(values: pd.Series) -> pd.Series:
        return pd.Series(passing(values.to_numpy().view(np.uint64), held.value))

    return found(column)


def distinct_texts(texts: DataFrame, firsts: DataFrame) -> DataFrame:
    """``texts(text, digest, key, doc)`` with one row per digest, that of the smallest doc.

    Only the texts that have copies are grouped. A filter of fixed size over
    their keys tells them from the others, which stay where they are read.
    """
    copied = firsts.where("n > 1")
    marked = texts.withColumn("copied", maybe_in(copied.select(F.xxhash64("digest").alias("key")), F.xxhash64("digest")))
    # The row to stay is named by its digest and doc, so that texts are not carried through an aggregate.
    first = marked.where("copied").join(firsts.select(F.col("digest").alias("_d"), F.col("first_doc").alias("_f")), (F.col("digest") == F.col("_d")) & (F.col("doc") == F.col("_f")))
    first = materialise(first.dropDuplicates(["digest"]).select("text", *_KEYS), "copied", 1000)
    return marked.where("not copied").select("text", *_KEYS).unionByName(first)


def pieces(listed: DataFrame, spec: Spec) -> DataFrame:
    """``listed(text, key, doc, runs)`` to the stretches of its runs: key, doc, the run's columns, piece."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, at = batch.column(3).flatten(), np.repeat(np.arange(len(batch)), batch.column(3).value_lengths().to_numpy())
            if not len(runs):
                continue
            columns = {f.name: runs.field(f.name) for f in runs.type}
            found, first, last, i = [], columns["first"].to_pylist(), columns["last"].to_pylist(), 0
            for text, n in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(3).value_lengths().to_pylist(), strict=True):
                units = spec.units(text)
                found += [spec.piece(units, first[j], last[j] + spec.length) for j in range(i, i + n)]
                i += n
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([batch.column(1).take(take), batch.column(2).take(take), *columns.values(), pa.array(found, pa.binary())], ["key", "doc", *columns, "piece"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in listed.schema["runs"].dataType.elementType.fields]
    return listed.select("text", *_KEYS, "runs").mapInArrow(emit, ", ".join(["key long, doc long", *fields, "piece binary"]))


def judged_runs(runs: DataFrame, repeats: Callable[[Column, Column, Column], Column], shard_contents: int | None) -> DataFrame:
    """The runs that go as a whole (whole), and those that stand for their content in the shards (mixed).

    Contents are mixed where others share their anchor, and heavy where these are
    more than ``shard_contents`` or long (None: never). Of the runs that stay so
    far, those of the first doc that has a content stand for it.
    """
    symbols = F.max(F.col("last") - F.col("first"))
    contents = runs.groupBy("c1", "c2").agg(F.min("anchor").alias("anchor"), F.min("doc").alias("low"), F.count("*").alias("n"), F.max("looped").alias("looped"), symbols.alias("symbols"))
    contents = materialise(contents, "contents")
    kinds = contents.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("symbols").alias("symbols")).where("kinds > 1")
    over = F.lit(False) if shard_contents is None else (F.col("kinds") > shard_contents) | (F.col("symbols") > CONTENT_SYMBOLS * shard_contents)
    kinds = kinds.select("anchor", over.alias("heavy"))
    several = contents.drop("symbols").join(kinds, "anchor", "left").withColumn("mixed", F.col("heavy").isNotNull() | F.col("looped")).where("n > 1 or mixed")
    joined = runs.drop("looped", "anchor").join(several.select("c1", "c2", "anchor", "low", "n", "heavy", "mixed"), ["c1", "c2"])
    judged = joined.withColumns({"whole": repeats(F.col("doc"), F.col("low"), F.col("n")), "mixed": F.col("mixed") & (F.col("doc") == F.col("low"))})
    # Only what goes on to the shards needs its content.
    names = [c for c in ("anchor", "seed", "c1", "c2", "n", "piece") if c in joined.columns]
    content = [F.when(F.col("mixed"), F.col(c)).alias(c) for c in names]
    judged = judged.where("whole or mixed").select("key", "doc", *content, "first", "last", F.coalesce("heavy", F.lit(False)).alias("heavy"), "whole", "mixed")
    judged = materialise(judged, "judged")
    discard(contents)
    return judged


def matched_spans(
    unique: DataFrame,
    spec: Spec,
    within_text: bool,
    repeats: Callable[[Column, Column, Column], Column],
    decide: Callable[[pd.DataFrame], pd.DataFrame],
    shard_bytes: int,
    shard_contents: int = SHARD_CONTENTS,
) -> DataFrame:
    """The texts of ``unique(text, key, doc)`` with a match, and their spans, the first and last windows of matching stretches.

    ``repeats(doc, low, n)`` says whether a stretch goes that n places have,
    ``low`` being the smallest doc among them. ``decide`` gets a shard
    (``pieces``) and returns key, doc, first, last of the windows that match; a
    shard of split anchors has their gram as seed.
    """
    runs = materialise(recurring_runs(unique, spec, recurring(unique, spec, within_text), within_text), "runs", 500)
    tables = [judged_runs(runs.where(F.pmod("anchor", F.lit(SLICES)) == i), repeats, shard_contents) for i in range(SLICES)]
    discard(runs)
    judged = reduce(DataFrame.unionByName, tables)
    run = F.struct("anchor", "c1", "c2", "n", "first", "last", "heavy")
    lists = materialise(judged.where("mixed").groupBy(*_KEYS).agg(F.collect_list(run).alias("runs")), "listed")
    listed = unique.where(maybe_in(lists.select("key"), F.col("key"))).join(lists, _KEYS)
    parts = materialise(pieces(listed, spec), "pieces", 1000)
    tables.append(parts)
    spans = [judged.where("whole").select(*_KEYS, "first", "last")]
    for i in range(len(DEPTHS) + 1):
        light, heavy = parts.where("not heavy"), parts.where("heavy")
        shards = max(1, (light.agg(F.sum(F.octet_length("piece"))).first()[0] or 0) // shard_bytes)
        decided = light.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(decide, "key long, doc long, first int, last int")
        tables.append(materialise(decided, "decided"))
        spans.append(tables[-1])
        if heavy.isEmpty():
            break
        runs = materialise(deeper_runs(heavy, spec, *DEPTHS[i], within_text), "runs", 500)
        judged = judged_runs(runs, repeats, shard_contents if i + 1 < len(DEPTHS) else None)
        discard(runs)
        tables.append(judged)
        spans.append(judged.where("whole").select(*_KEYS, "first", "last"))
        parts = judged.where("mixed")
    spans = reduce(DataFrame.unionByName, spans).groupBy(*_KEYS).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    spans = materialise(spans, "spans")
    discard(*tables)
    return unique.where(maybe_in(spans.select("key"), F.col("key"))).join(spans, _KEYS)


def stretches(gone: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last positions of stretches of ``gone``; a position in ``starts`` begins a new one."""
    head = gone.copy()
    head[1:] &= ~gone[:-1]
    head[starts] = gone[starts]
    tail = np.ones(len(gone), bool)
    tail[:-1] = ~gone[1:]
    tail[starts[starts > 0] - 1] = True
    return np.flatnonzero(head), np.flatnonzero(gone & tail)
