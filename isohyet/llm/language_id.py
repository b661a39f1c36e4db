"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent letter n-grams, in
order. A document is compared to each profile by the out-of-place distance: the
sum, over the document's own most frequent n-grams, of how far each stands from
its place in the profile; an n-gram that the profile lacks costs the profile
length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

PROFILE_SIZE = 300
SAMPLE_PER_LANG = 2000
UNDETERMINED = "und"
_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once in a worker."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1- to 3-grams of a text's lower-cased words, as packed code points, and their counts.

    Words are padded with one space on either side; no n-gram spans two words.
    """
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    is_letter = letters[np.minimum(code, len(letters) - 1)]
    if not is_letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = np.concatenate(([_SPACE], np.where(is_letter, code, _SPACE), [_SPACE]))
    space = code == _SPACE
    code = code[np.concatenate(([True], ~(space[1:] & space[:-1])))]
    space = code == _SPACE
    pair = code[:-1] << 21 | code[1:]
    triple = pair[:-1] << 21 | code[2:]
    return np.unique(np.concatenate((code[~space], pair, triple[~space[1:-1]])), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams in order; ties by code point."""
    return grams[np.lexsort((grams, -counts))[:size]]


def fit_profiles(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG, size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Profiles ``{lang: [n-gram, ...]}`` learned from ``docs(doc_id, text, lang)``.

    Rows without lang, text or doc_id are not learned from. Learns from a
    sample of about ``sample_per_lang`` documents a language, chosen by a hash
    of doc_id: the bound on what fitting reads. What reaches the driver is
    ``size`` n-grams a language.
    """
    known = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null")
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, sample_per_lang / n)])[F.col("lang")]
    sample = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = _letters()
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                grams, counts = ngrams(" \n".join(texts), letters)
                yield pd.DataFrame({"lang": lang, "gram": grams, "n": counts})

    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = (
        sample.select("lang", "text")
        .mapInPandas(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= size)
        .collect()
    )
    profiles: dict[str, list[int]] = {lang: [] for lang in sorted(totals)}
    for r in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        profiles[r["lang"]].append(r["gram"])
    return {lang: grams for lang, grams in profiles.items() if grams}


class Classifier:
    """Out-of-place distances of a document to every profile at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.size, self.langs = size, sorted(profiles)
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.places = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.places[i, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))
        self.letters = _letters()

    def __call__(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs:
            return UNDETERMINED, 0.0
        grams = ranked(*ngrams(text, self.letters), self.size)
        if not len(grams):
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.grams, grams)
        at = np.where(self.grams[np.minimum(at, len(self.grams) - 1)] == grams, at, len(self.grams))
        places = self.places[:, at]
        distance = np.where(places < 0, self.size, np.minimum(np.abs(places - np.arange(len(grams))), self.size)).sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(grams)))


def predictor(profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
    """A column function ``text -> struct(lang_pred, score)``."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = Classifier(profiles, size)
        for batch in texts:
            yield pd.DataFrame([classify(x) for x in batch], columns=["lang_pred", "score"])

    return predict


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold that nothing is learned from. A null doc_id counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify_languages(docs: DataFrame, profiles: dict[str, list[int]] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Without ``profiles``, learns them from the rows that are not held out.
    score is 1 less the out-of-place distance over its greatest value. A text
    that is null or has no letter gives ``und`` and 0, as does every text where
    nothing could be learned. Ties between languages go to the first by name.
    Repeated rows give repeated rows; an empty table gives an empty result.
    Other columns of ``docs`` are ignored, lang too, except to learn from.
    """
    if profiles is None:
        profiles = fit_profiles(docs.where(~held_out(F.col("doc_id"))))
    predict = predictor(profiles)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("_p")).select(
        "doc_id", "held_out", "_p.lang_pred", "_p.score"
    )


def keep_identified(docs: DataFrame, min_score: float = 0.2, profiles: dict[str, list[int]] | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with at least ``min_score``."""
    if profiles is None:
        profiles = fit_profiles(docs.where(~held_out(F.col("doc_id"))))
    predict = predictor(profiles)
    columns = docs.columns
    name = "lang"
    while name in columns:
        name = f"_{name}"
    return (
        docs.withColumn(name, predict("text"))
        .where((F.col(f"{name}.lang_pred") != UNDETERMINED) & (F.col(f"{name}.score") >= min_score))
        .select(*[F.col(f"`{c}`") for c in columns])
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))
