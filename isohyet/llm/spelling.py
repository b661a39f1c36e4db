"""Spelling variants: words that one edit separates, found by blocked Gram matrices.

One edit changes a word's letter counts by a squared distance of 1 (a letter more
or less, the length changes by one) or 2 (a letter for another). Words are dealt to
blocks by their length and the letters that they have of each class; blocks that
one edit can join share a centre, the counts of the letters that both have. At a
centre, NumPy products of the letter counts give all squared distances, and what
is near enough has its edit verified.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table

#: Distinct words that a task counts before it gives them out.
FLUSH_WORDS = 1 << 18
#: Pairs of words a word may be multiplied with, on average, before blocks are made finer.
PAIRS_PER_WORD = 8192
#: Words and characters of a tile's side.
TILE_WORDS, TILE_CHARS = 2048, 1 << 22
#: Elements of an intermediate array while edits are verified.
VERIFIED_AT_ONCE = 1 << 22
#: Above this length a squared distance no longer fits single precision.
SINGLE = 1500

_LOWER = {i: i + 32 for i in range(65, 91)}
_LETTERS = [*range(97, 123), *range(0xC0, 0x100)]
_PLACE = np.zeros(256, np.int64)
_PLACE[_LETTERS] = np.arange(len(_LETTERS))


def counted_words(docs: DataFrame, min_length: int = 7, one_in: int = 31) -> DataFrame:
    """(word, n) of all runs of letters of ``docs(doc_id, text)``.

    Only A-Z are lower-cased. Where ``one_in`` divides the CRC-32 h of doc_id, a colon
    and the run, the run loses its code point h modulo its length. Results shorter
    than ``min_length`` are left out, and runs that are shorter before any loss cannot
    give others. Null texts have no words; a null doc_id counts as an empty one.
    """
    run = re.compile(f"[A-Za-zÀ-ÿ]{{{min_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                prefix = zlib.crc32(f"{doc_id or ''}:".encode())
                text = text or ""
                runs = run.findall(text) if len(text) < 1 << 22 else (m[0] for m in run.finditer(text))
                for word, n in Counter(runs).items():
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    h = zlib.crc32(word.encode(), prefix)
                    if h % one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    total[word] += n
                if len(total) >= FLUSH_WORDS:
                    yield given(total)
        yield given(total)

    def given(total: Counter[str]) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
        total.clear()
        return out

    partial = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _classes(words: DataFrame, k: int) -> Column:
    """array<int>: the letters of ``word`` in each of k classes, dealt so that each class takes common and rare letters."""
    seen = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").count().collect()  # 90 letters at most
    classes = [""] * min(k, max(1, len(seen)))
    for i, r in enumerate(sorted(seen, key=lambda r: (-r["count"], r["c"]))):
        turn, at = divmod(i, len(classes))
        classes[len(classes) - 1 - at if turn % 2 else at] += r["c"]
    return F.array(*[F.length("word") - F.length(F.translate("word", letters, "")) for letters in classes])


def _centres(block: str) -> Column:
    """array<struct<centre, lost>>: the block itself (lost -1), and the block less one letter of each class that it has (lost: the class)."""
    i = F.sequence(F.lit(0), F.size(block) - 1)
    less = F.transform(F.filter(i, lambda j: F.get(F.col(block), j) > 0), lambda j: F.struct(F.transform(F.col(block), lambda x, at: F.when(at == j, x - 1).otherwise(x)).alias("centre"), j.alias("lost")))
    return F.concat(F.array(F.struct(F.col(block).alias("centre"), F.lit(-1).alias("lost"))), less)


def blocked(words: DataFrame, pairs_per_word: int = PAIRS_PER_WORD) -> tuple[DataFrame, DataFrame]:
    """``words(word, n)`` with their block, and (centre, size) of all centres.

    The number of classes doubles from 4 until the products at all centres
    take at most ``pairs_per_word`` pairs a word, or every letter is a class.
    """
    total, k = words.count(), 4
    while True:
        of = words.withColumn("block", _classes(words, k))
        sizes = materialise(
            of.groupBy("block").agg(F.count("*").alias("m")).select(F.explode(_centres("block")).alias("c"), "m").groupBy("c.centre").agg(F.sum("m").alias("size")), "centres"
        )
        pairs = sizes.agg(F.sum(F.col("size").cast("double") * F.col("size"))).first()[0] or 0
        if pairs <= pairs_per_word * total or k >= len(_LETTERS):
            return of, sizes
        k *= 2


def near_words(words: DataFrame, pairs_per_word: int = PAIRS_PER_WORD) -> DataFrame:
    """(word, other, other_n): for each of the distinct ``words(word, n)`` the words at one edit; each pair both ways.

    Words are of the letters a-z and U+00C0 to U+00FF. A centre that holds more
    words than a tile is cut into slices, and each pair of slices is a tile of its
    own, so no task holds more than two slices at a time.
    """
    of, sizes = blocked(words, pairs_per_word)
    length = F.aggregate("centre", F.lit(0), lambda a, x: a + x)
    limit = F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.floor(F.lit(TILE_CHARS) / (length + 1))))
    hot = sizes.where(F.col("size") > limit).select("centre", F.ceil(F.col("size") / limit).cast("int").alias("slices"))
    dealt = of.select("word", "n", F.explode(_centres("block")).alias("_c")).select("word", "n", "_c.centre", "_c.lost")
    dealt = dealt.join(hot, "centre", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("slices")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    tiles = dealt.select(F.struct("centre", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")).alias("tile"), "own", "lost", "word", "n")
    # The name of a tile is short and the same for all its rows; Python needs only to see where it changes.
    tiles = tiles.select(F.concat_ws(",", F.col("tile.centre").cast("array<string>"), F.col("tile.x").cast("string"), F.col("tile.y").cast("string")).alias("tile"), F.col("tile.x").alias("x"), F.col("tile.y").alias("y"), "own", "lost", "word", "n")
    sorted_ = tiles.repartition("tile").sortWithinPartitions("tile")
    return sorted_.mapInArrow(_tiles, "word string, other string, other_n long")


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of every tile; the rows of a tile follow one another."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    words, others, counts = [], [], []
    for name, tile in groupby(rows, key=lambda row: row[0]):
        tile = list(tile)
        centre, x, y = [int(c) for c in name.split(",")[:-2]], tile[0][1], tile[0][2]
        first = next((i for i, c in enumerate(centre) if c), len(centre))
        sides = [_Side([r for r in tile if r[3] == s], first) for s in ((x,) if x == y else (x, y))]
        for a, b in _near(sides):
            words += [a[0], b[0]]
            others += [b[0], a[0]]
            counts += [b[1], a[1]]
        if len(words) >= 1 << 14:
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(others, pa.string()), pa.array(counts, pa.int64())], ["word", "other", "other_n"])
            words, others, counts = [], [], []
    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(others, pa.string()), pa.array(counts, pa.int64())], ["word", "other", "other_n"])


class _Side:
    """The words of a slice at a centre: the longer ones, which lose a letter to it, and the shorter ones, which are at it."""

    def __init__(self, rows: list[tuple], first: int) -> None:
        self.long = [(r[5], r[6]) for r in rows if r[4] >= 0]
        self.short = [(r[5], r[6]) for r in rows if r[4] < 0]
        self.lost = np.array([r[4] for r in rows if r[4] >= 0], np.int64)
        # Two words of one block meet at all centres of the block; the one that loses its first class counts.
        self.home = self.lost <= first
        self.long_codes, self.short_codes = _codes(self.long), _codes(self.short)


def _codes(words: list[tuple[str, int]]) -> np.ndarray:
    if not words:
        return np.zeros((0, 0), np.uint8)
    return np.frombuffer("".join(w for w, _ in words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _letter_counts(codes: np.ndarray) -> np.ndarray:
    n, width = codes.shape
    at = _PLACE[codes] + np.arange(n)[:, None] * len(_LETTERS)
    return np.bincount(at.ravel(), minlength=n * len(_LETTERS)).reshape(n, len(_LETTERS)).astype(np.float32 if width <= SINGLE else np.float64)


def _apart(a: np.ndarray, b: np.ndarray, squared: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the letter counts a and b at this squared distance, by one matrix product."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = np.ones
    left = np.hstack([a * -2, (a * a).sum(1, keepdims=True), one((len(a), 1), a.dtype)])
    right = np.hstack([b, one((len(b), 1), b.dtype), (b * b).sum(1, keepdims=True)])
    return np.nonzero(left @ right.T == squared)


def _near(sides: list[_Side]) -> Iterator[tuple[tuple[str, int], tuple[str, int]]]:
    """Pairs at one edit, within one side or across two."""
    counts = [(_letter_counts(s.long_codes) if s.long else s.long_codes, _letter_counts(s.short_codes) if s.short else s.short_codes) for s in sides]
    p, q = (0, 0) if len(sides) == 1 else (0, 1)
    i, j = _apart(counts[p][0], counts[q][0], 2)
    apart = sides[p].lost[i] != sides[q].lost[j]
    wanted = (apart | sides[p].home[i]) & ((i < j) if p == q else True)
    i, j = i[wanted], j[wanted]
    same = _verified(sides[p].long_codes, sides[q].long_codes, i, j, _replaced)
    yield from ((sides[p].long[a], sides[q].long[b]) for a, b in zip(i[same].tolist(), j[same].tolist()))
    for p, q in {(p, q), (q, p)}:
        i, j = _apart(counts[p][0], counts[q][1], 1)
        same = _verified(sides[p].long_codes, sides[q].short_codes, i, j, _deleted)
        yield from ((sides[p].long[a], sides[q].short[b]) for a, b in zip(i[same].tolist(), j[same].tolist()))


def _verified(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, edit) -> np.ndarray:
    step = max(1, VERIFIED_AT_ONCE // max(1, a.shape[1]))
    return np.concatenate([edit(a[i[at : at + step]], b[j[at : at + step]]) for at in range(0, len(i), step)] or [np.zeros(0, bool)])


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def _deleted(long: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Whether the start and the end that both share cover the shorter word."""
    start = np.logical_and.accumulate(long[:, :-1] == short, axis=1).sum(1)
    end = np.logical_and.accumulate((long[:, 1:] == short)[:, ::-1], axis=1).sum(1)
    return start + end >= short.shape[1]


def grouped_spellings(words: DataFrame, times: int = 10, pairs_per_word: int = PAIRS_PER_WORD) -> DataFrame:
    """One row per row of the distinct ``words(word, n)``: word, form, root, n, n_near, form_n.

    n_near counts the words at one edit. form is the most frequent of them, ties to the
    smallest in code-point order, if it is at least ``times`` (2 or more) as frequent
    as the word, else null. root follows forms to the last one. Every form is ``times``
    as frequent as what leads to it, so a path has at most as many steps as n has
    digits to that base. An empty table gives no rows.
    """
    words = materialise(words.select("word", F.col("n").cast("long")), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = near_words(words, pairs_per_word).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best"))
    joined = words.join(near, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    takes = -F.col("_best.n") >= times * F.col("n")
    joined = materialise(joined.select("word", "n", "n_near", F.when(takes, F.col("_best.word")).alias("form"), F.when(takes, -F.col("_best.n")).alias("form_n")), "forms")
    paths = joined.where("form is not null").select("word", F.col("form").alias("root"))
    most = joined.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(1 + math.log(most, times)))):
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        paths = materialise(paths.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "paths")
    return joined.join(paths, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_spellings(counted_words(table(spark, sf_dir, "documents")).where("n >= 2"))
