"""Personal data by bootstrapped contextual extraction.

Seeds are what four base patterns find. The words beside a seed make lexical
patterns; the same words stand beside other things of an identifier's shape, the
candidates. Patterns and values form a graph: a pattern is as precise as the share
of all its places in the corpus that known values fill, and a candidate is as
likely as its patterns together make it. Spark scores the graph in rounds, each of
which takes up the values of the round before; occurrences of values that end up
likely are spans besides the base ones.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table
from .prefix_crc import NORMAL, ngram_crcs

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_VALUES, MIN_PRECISION, MIN_SCORE = 3, 0.5, 0.7
BATCH_ROWS = 64
#: Bits of the filter that spares words without a pattern the count; what it lets through is counted by name.
FILTER_BITS = 26
FLUSH_PATTERNS = 1 << 18

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# The part of an email from @ on; what is before it is read backwards, so long runs are read once.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can only begin where a run of digits does.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Shapes of candidates: digits in groups, colon-separated hexadecimal groups, and anything with an @.
NUMBER = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9])++")
GROUPS = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = "\"'`<>()[]{},;:.!?"
WORDS = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_LOWER = {i: i + 32 for i in range(65, 91)}

ROW = "row long, doc_id string, base array<struct<kind:string,start:int,end:int>>, seen array<struct<kind:string,value:string,start:int,end:int,seed:boolean,patterns:array<string>>>"


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; leftmost, non-overlapping per kind, failing matches dropped."""
    out, last = [], 0
    for m in DOMAIN.finditer(text) if "@" in text else ():
        before = text[last : m.start()]
        local = len(before) - len(before.rstrip(LOCAL))
        if local:
            out.append(("email", m.start() - local, m.end()))
            last = m.end()
    for m in IP.finditer(text):
        if all(len(x := g.lstrip("0")) < 4 and int(x or 0) < 256 for g in m.groups()):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def _value(kind: str, text: str) -> str:
    return _digits(text) if kind in ("card", "phone") else text.translate(_LOWER)


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what has an identifier's shape and lies outside ``taken``; a number of 12 to 15 digits may be of two kinds."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        for m in TOKEN.finditer(text):
            if "@" in m[0]:
                start = m.start() + len(m[0]) - len(m[0].lstrip(EDGES))
                end = m.end() - len(m[0]) + len(m[0].rstrip(EDGES))
                if start < end and "@" in text[start + 1 : end - 1]:
                    found.append(("email", start, end))
    if ":" in text:
        found += [("ip", *m.span()) for m in GROUPS.finditer(text) if any(c not in ":" for c in m[0])]
    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= 7 and 7 <= (n := len(_digits(m[0]))) <= 19:
            found += [(kind, *m.span()) for kind, low, high in (("card", 12, 19), ("phone", 7, 15)) if low <= n <= high]
    taken = sorted(taken)
    out: list[tuple[str, int, int]] = []
    far = 0  # where the last kept candidate ends
    ends, reach = [s for s, _ in taken], []
    for _, e in taken:
        reach.append(max(e, reach[-1] if reach else 0))
    for kind, start, end in sorted(found, key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        i = bisect_left(ends, end)
        overlaps = i > 0 and reach[i - 1] > start
        if not overlaps and (start >= far or (out and out[-1][1:] == (start, end))):
            out.append((kind, start, end))
            far = end
    return out


def _contexts(starts: list[int], ends: list[int], words: list[str], start: int, end: int) -> list[str]:
    """Patterns of a place: the one and two words before it, and after it."""
    i, j = bisect_right(ends, start), bisect_left(starts, end)
    before, after = words[max(0, i - 2) : i], words[j : j + 2]
    return [f"l:{' '.join(before[-n:])}" for n in range(1, len(before) + 1)] + [f"r:{' '.join(after[:n])}" for n in range(1, len(after) + 1)]


def _seen(text: str) -> tuple[list[dict], list[dict]]:
    base = base_spans(text)
    others = candidates(text, [(s, e) for _, s, e in base])
    seen: list[dict] = []
    if base or others:
        found = [(m[0].translate(_LOWER), *m.span()) for m in WORDS.finditer(text)]
        words, starts, ends = [f[0] for f in found], [f[1] for f in found], [f[2] for f in found]
        for seed, spans in ((True, base), (False, others)):
            for kind, start, end in spans:
                seen.append({"kind": kind, "value": _value(kind, text[start:end]), "start": start, "end": end, "seed": seed, "patterns": _contexts(starts, ends, words, start, end)})
    return [{"kind": k, "start": s, "end": e} for k, s, e in base], seen


def occurrences(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, seen) for each row of docs; row is a number of its own."""
    kinds = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    seens = pa.struct([("kind", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_seen(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array([f[0] for f in found], pa.list_(kinds)), pa.array([f[1] for f in found], pa.list_(seens))], ["row", "doc_id", "base", "seen"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(scan, ROW.replace("doc_id string", f"doc_id {kind}"))


def _crc(words: Column) -> Column:
    return F.crc32(F.encode(words, "UTF-8"))


def _filter(patterns: DataFrame) -> np.ndarray:
    """A bitmap of 2^FILTER_BITS bits of the CRCs of the patterns' words, built as bitmaps in Spark."""
    bit = F.shiftrightunsigned(_crc(F.substring("pattern", 3, 1 << 30)), 32 - FILTER_BITS) + 1  # these functions count from 1
    maps = patterns.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("m"))
    out = np.zeros((1 << FILTER_BITS >> 15, 4096), np.uint8)
    for r in maps.collect():  # 8 MB at every size
        out[r["b"] - 1] = np.frombuffer(r["m"], np.uint8)
    return out.reshape(-1)


def places(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, places): how often the words of each of ``patterns(pattern)`` stand in docs, whatever is beside them."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter(patterns))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        marks = bits.value
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or b""
                words: list[bytes] | None = None
                done = 0
                for crcs, n in ngram_crcs(text, 2):
                    at = (crcs >> np.uint32(32 - FILTER_BITS)).astype(np.int64)
                    hits = np.flatnonzero(marks[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                    if len(hits):
                        words = words or text.translate(NORMAL).split()
                        # The block's single words come first, then its pairs, of which the first may begin a word before it.
                        for i in hits.tolist():
                            total[words[done + i] if i < n else b" ".join(words[(j := max(0, done - 1) + i - n) : j + 2])] += 1
                    done += n
                if len(total) >= FLUSH_PATTERNS:
                    yield given(total)
        yield given(total)

    def given(total: Counter[bytes]) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in total], pa.string()), pa.array(total.values(), pa.int64())], ["words", "n"])
        total.clear()
        return out

    counted = docs.select(F.col("text").cast("binary")).mapInArrow(count, "words string, n long").groupBy("words").agg(F.sum("n").alias("places"))
    return patterns.select("pattern", F.substring("pattern", 3, 1 << 30).alias("words")).join(counted, "words").select("pattern", "places")


def scored(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS, min_values: int = MIN_VALUES, min_precision: float = MIN_PRECISION, min_score: float = MIN_SCORE) -> DataFrame:
    """(kind, value, score) of the seeds, score 1, and of the candidates that are likely after so many rounds.

    ``edges(kind, value, seed, pattern, n)`` say how often a value stands in a pattern;
    ``totals(pattern, places)`` how many places a pattern has. In each round a
    pattern is confident if at least ``min_values`` different known values fill it
    and their occurrences, weighed by score, at least ``min_precision`` of its
    places. A candidate's score is the noisy-or of its confident patterns'
    precisions, and it is known from ``min_score`` on. Ties do not matter: nothing is
    ranked.
    """
    seeds = edges.where("seed").select("kind", "value", F.lit(1.0).alias("score")).distinct()
    known = seeds
    for _ in range(rounds):
        filled = edges.join(known, ["kind", "value"]).groupBy("kind", "pattern").agg(F.sum(F.col("n") * F.col("score")).alias("filled"), F.count_distinct("value").alias("values"))
        precision = F.least(F.col("filled") / F.col("places"), F.lit(0.999))
        confident = filled.where(F.col("values") >= min_values).join(totals, "pattern").select("kind", "pattern", precision.alias("precision")).where(F.col("precision") >= min_precision)
        now = edges.where("not seed").join(materialise(confident, "patterns"), ["kind", "pattern"]).groupBy("kind", "value").agg((1 - F.exp(F.sum(F.log(1 - F.col("precision"))))).alias("score"))
        found = now.where(F.col("score") >= min_score).join(seeds, ["kind", "value"], "left_anti")
        known = materialise(seeds.union(found), "instances")
    return known


def personal_data(docs: DataFrame, rounds: int = ROUNDS, min_values: int = MIN_VALUES, min_precision: float = MIN_PRECISION, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, base, spans, arrays of struct(kind, start, end).

    A value that the base patterns find in one place, in the same digits or letters,
    is known in all places of an identifier's shape.
    base are the spans of the base patterns, spans these and what the method adds,
    both by kind as listed and then start. Positions are code points, end exclusive.
    Null, empty and plain texts have no spans; texts of any length are read whole,
    in time linear in their length; repeated rows and doc_ids each give a row; an
    empty table gives no rows. A candidate of two kinds takes the likelier, ties the
    first listed. Other columns are ignored.
    """
    rows = materialise(occurrences(docs), "seen", BATCH_ROWS)
    seen = rows.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    # A value without a word beside it has one edge, to a pattern that has no places.
    pattern = F.explode_outer("patterns").alias("pattern")
    edges = materialise(seen.select("kind", "value", "seed", pattern).groupBy("kind", "value", "seed", "pattern").agg(F.count("*").alias("n")), "edges")
    # No pattern with fewer values can become confident.
    able = edges.where("pattern is not null").groupBy("kind", "pattern").agg(F.count_distinct("value").alias("v")).where(F.col("v") >= min_values).select("pattern").distinct()
    totals = materialise(places(docs, materialise(able, "able")), "places")
    likely = scored(edges, totals, rounds, min_values, min_precision, min_score)
    added = seen.where("not seed").join(likely, ["kind", "value"])
    order = F.array(*[F.lit(k) for k in KINDS])
    added = added.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", -F.array_position(order, F.col("kind")))).alias("kind"))
    added = added.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    spans = F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    listed = F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("_k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    by_kind = F.transform(F.array_sort(listed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("row", "doc_id", "base").join(added, "row", "left").select("doc_id", "base", by_kind.alias("spans"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in KINDS]
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
