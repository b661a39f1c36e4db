"""Near-duplicate detection: MinHash bands and sequential Bayesian verification.

Documents with the same words in the same order are one node. Bands of MinHash
values put nodes in buckets, and nodes that buckets connect form a cluster,
which goes through in blocks: within a block the pairs that share a bucket are
compared signature batch by signature batch, and a pair is dropped as soon as
the posterior probability that its similarity reaches the threshold falls below
a bound, which all looks together take from one miss probability. Survivors are
verified on their full shingle sets. Pairs never become rows; a block returns
the links that connect its nodes. A cluster of more nodes than a block holds is
first linked within slices of its buckets, and then only pairs are compared that
share a bucket and are in different components still.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table
from .components import components

#: Probability that bands miss a link at the threshold, and that the posterior bounds of all looks together do.
MISS = 1e-6
BATCH = 32
LEAST_ROWS = 7
#: Similarity of unrelated texts, and how many of them may share a bucket with a document by chance.
CHANCE, CHANCE_PAIRS = 0.07, 0.5
BLOCK = 256
#: Bands whose buckets link the nodes of large clusters first, and the nodes that a packed group has on average.
ROUNDS, GROUP_ROWS = 4, 1024
CHUNK = 1024
COLUMNS = 1 << 14
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.lower().split() if text else []


def word_ids(words: list[bytes]) -> tuple[int | None, int | None]:
    """The halves of a 128-bit cryptographic digest of a word sequence; equal sequences are one node."""
    if not words:
        return None, None
    digest = blake2b(b" ".join(words), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def shingle_set(words: list[bytes], k: int) -> set:
    """Distinct k-word shingles; of fewer words, the whole sequence as one."""
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k)), strict=False))


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ hashes[i : i + n]) * _MIX
        out ^= out >> np.uint64(31)
    return np.unique(out)


def banding(n: int, percent: int, miss: float = MISS) -> tuple[int, int]:
    """Bands and rows for n nodes.

    Rows grow with the logarithm of n, so that the number of chance candidates
    of a document does not grow; bands keep the probability of missing a link
    at the threshold at ``miss``.
    """
    t, rows = percent / 100, LEAST_ROWS
    while True:
        bands = math.ceil(math.log(miss) / math.log1p(-(t**rows)))
        if n * bands * CHANCE**rows <= CHANCE_PAIRS:
            return bands, rows
        rows += 1


def multipliers(n: int, seed: int = 42) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhash(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The upper 16 bits of the smallest products, one for each multiplier."""
    low = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), CHUNK):
        np.minimum(low, (hashes[i : i + CHUNK, None] * by).min(axis=0), out=low)
    return (low >> np.uint64(48)).astype(np.uint16)


def least_matches(n: int, threshold: float, miss: float) -> int:
    """The fewest matches among n values for which P(similarity >= threshold), from a uniform prior, is at least ``miss``."""
    x = (np.arange(200_000) + 0.5) / 200_000
    log_x, log_y = np.log(x), np.log1p(-x)

    def enough(m: int) -> bool:
        density = m * log_x + (n - m) * log_y
        density = np.exp(density - density.max())
        return density[x >= threshold].sum() >= miss * density.sum()

    return min(bisect_left(range(n + 1), True, key=enough), n)


def fewer(n: int, m: int, p: float) -> float:
    """P(fewer than m matches among n independent values that match with probability p)."""
    log_n = math.lgamma(n + 1)
    return sum(math.exp(log_n - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)) for k in range(m))


def needed(steps: Sequence[int], threshold: float, miss: float) -> list[int]:
    """The matches that each look asks for, so that all looks together lose a pair at the threshold with a probability of at most ``miss``."""
    bound = miss / len(steps)
    while True:
        need = [least_matches(n, threshold, bound) for n in steps]
        if sum(fewer(n, m, threshold) for n, m in zip(steps, need, strict=True)) <= miss:
            return need
        bound /= 2


def signatures(docs: DataFrame, k: int, size: int) -> DataFrame:
    """``docs(doc_id, text)`` to doc_id, n_shingles, id, check, sig; id and check, a digest of the words, and sig are null without words."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = multipliers(size)
        for batch in batches:
            sizes, ids, checks, sigs = [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = words_of(text)
                hashes = shingle_hashes(words, k)
                sizes.append(len(hashes))
                for column, half in zip((ids, checks), word_ids(words), strict=True):
                    column.append(half)
                sigs.append(minhash(hashes, by).tobytes() if words else None)
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(checks, pa.int64()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "id", "check", "sig"])

    return docs.select("doc_id", "text").mapInArrow(sign, f"doc_id {doc_id}, n_shingles long, id long, check long, sig binary")


def told_apart(signed: DataFrame) -> DataFrame:
    """``signed`` with a new id where one stands for different words, as the digest's second half shows."""
    several = signed.where("id is not null").groupBy("id").agg(F.min("check").alias("a"), F.max("check").alias("z")).where("a <> z").select(F.col("id").alias("_shared"))
    several = materialise(several, "shared_ids")
    if several.isEmpty():
        return signed
    marked = signed.join(several, F.col("id") == F.col("_shared"), "left")
    return marked.withColumn("id", F.when(F.col("_shared").isNotNull(), F.xxhash64("id", "check")).otherwise(F.col("id"))).drop("_shared")


def band_matrix(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The bucket of each node (row) in each band (column)."""
    parts = sig[:, : bands * rows].reshape(-1, bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _MIX, parts.shape[:2]).copy()
    for i in range(rows):
        key = (key ^ parts[:, :, i]) * _MIX
        key ^= key >> np.uint64(29)
    return key


def band_keys(nodes: DataFrame, bands: int, rows: int, carried: Sequence[str] = ()) -> DataFrame:
    """``nodes(id, sig)`` to (key, id), one row per band, with the ``carried`` columns, which are long."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = band_matrix(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(batch), -1), bands, rows)
            others = [pa.array(np.repeat(batch.column(i).to_numpy(), bands)) for i in (0, *range(2, batch.num_columns))]
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), *others], ["key", "id", *carried])

    return nodes.select("id", "sig", *carried).mapInArrow(split, ", ".join(f"{c} long" for c in ("key", "id", *carried)))


class Verifier:
    """Finds the links within a block, or between two blocks, of a cluster."""

    def __init__(self, k: int, percent: int, miss: float, bands: int, rows: int):
        self.k, self.percent, self.bands, self.rows = k, percent, bands, rows
        self.steps = range(BATCH, -(-bands * rows // BATCH) * BATCH + 1, BATCH)
        self.need = needed(self.steps, percent / 100, miss)

    def survivors(self, sig: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that share a bucket and that no posterior bound rules out."""
        keys = band_matrix(sig, self.bands, self.rows)
        share = np.zeros((len(left), len(right)), bool)
        for band in range(self.bands):
            share |= keys[left, band][:, None] == keys[right, band][None, :]
        i, j = np.nonzero(share)
        a, b = left[i], right[j]
        once = (a < b) if left is right or np.array_equal(left, right) else np.ones(len(a), bool)
        a, b = a[once], b[once]
        matches = np.zeros(len(a), np.int64)
        for end, least in zip(self.steps, self.need, strict=True):
            matches += (sig[a, end - BATCH : end] == sig[b, end - BATCH : end]).sum(axis=1)
            ok = matches >= least
            a, b, matches = a[ok], b[ok], matches[ok]
        return a, b

    def common(self, sets: list[set], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Intersection sizes of pairs: one by one for few, by products of incidence matrices for many."""
        used = np.unique(np.concatenate((a, b)))
        if len(a) <= 4 * len(used):
            return np.array([len(sets[x] & sets[y]) for x, y in zip(a, b, strict=True)], np.int64)
        place = {int(x): i for i, x in enumerate(used)}
        numbers: dict = {}
        cells = [(i, numbers.setdefault(s, len(numbers))) for x, i in place.items() for s in sets[x]]
        row, col = np.array(cells).T
        shared = np.flatnonzero(np.bincount(col) > 1)
        where = np.full(len(numbers), -1)
        where[shared] = np.arange(len(shared))
        row, col = row[where[col] >= 0], where[col[where[col] >= 0]]
        total = np.zeros((len(used), len(used)), np.float32)
        for start in range(0, len(shared), COLUMNS):
            here = (col >= start) & (col < start + COLUMNS)
            m = np.zeros((len(used), min(COLUMNS, len(shared) - start)), np.float32)
            m[row[here], col[here] - start] = 1
            total += m @ m.T
        at = np.array([place[int(x)] for x in a]), np.array([place[int(y)] for y in b])
        return total[at].astype(np.int64)

    def links(self, ids: np.ndarray, sig: np.ndarray, texts: list[str], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        """Verified links that connect all that is linked; links between nodes that are connected already are left out."""
        a, b = self.survivors(sig, left, right)
        if not len(a):
            return []
        sets: list = [None] * len(texts)
        for x in np.unique(np.concatenate((a, b))):
            sets[x] = shingle_set(words_of(texts[x].encode()), self.k)
        size = np.array([len(s or ()) for s in sets])
        both = self.common(sets, a, b)
        ok = 100 * both >= self.percent * (size[a] + size[b] - both)
        root = list(range(len(ids)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for x, y in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[p] = q
                out.append((int(ids[x]), int(ids[y])))
        return out


def verified_links(pieces: DataFrame, verifier: Verifier, groups: int | None = None) -> DataFrame:
    """``pieces(id, sig, text, piece, block, low, high)`` to links (a, b).

    A piece of work is (piece, low, high) and compares its nodes of block low
    with those of block high, which may be the same. Pieces are packed by hash
    into ``groups`` groups for pandas, or each is a group of its own.
    """

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, low, high), g in pdf.groupby(["piece", "low", "high"]):
            sig = np.frombuffer(b"".join(g["sig"]), np.uint16).reshape(len(g), -1)
            side = g["block"].to_numpy()
            left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
            out += verifier.links(g["id"].to_numpy(), sig, g["text"].tolist(), left, right)
        return pd.DataFrame(out, columns=["a", "b"])

    at = F.xxhash64("piece", "low", "high")
    group = F.pmod(at, F.lit(groups)) if groups else at
    return pieces.select("id", "sig", "text", "piece", "block", "low", "high", group.alias("group")).groupBy("group").applyInPandas(work, "a long, b long")


def packed(rows: int, spark: SparkSession) -> int:
    """Groups for pieces of ``rows`` nodes altogether; a group's share does not grow with the data."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // GROUP_ROWS))


def alone(nodes: DataFrame, piece: Column, block: Column | None = None) -> DataFrame:
    """Pieces that compare a block with itself."""
    block = F.lit(0) if block is None else block.cast("int")
    return nodes.select("id", "sig", "text", piece.alias("piece"), block.alias("block"), block.alias("low"), block.alias("high"))


def bucket_pieces(large: DataFrame, bands: int, rows: int) -> DataFrame:
    """Pieces of the nodes that share a bucket of one of ``ROUNDS`` bands, a bucket of many nodes in slices of about ``BLOCK``.

    Slices are drawn anew for each band. So near copies without number link
    within slices, and slices link by the nodes they share with those of
    other bands; each node is moved ``ROUNDS`` times at most.
    """
    chosen = [r * bands // ROUNDS for r in range(ROUNDS)]

    @F.pandas_udf("array<long>")
    def buckets(sig: pd.Series) -> pd.Series:
        key = band_matrix(np.frombuffer(b"".join(sig), np.uint16).reshape(len(sig), -1), bands, rows)
        return pd.Series(list(np.ascontiguousarray(key[:, chosen]).view(np.int64)))

    placed = materialise(large.select("id", F.explode(buckets("sig")).alias("key")), "placed")
    counts = placed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    slices = F.ceil(F.col("n") / BLOCK)
    placed = placed.join(counts, "key").select("id", "key", F.pmod(F.xxhash64("id", "key"), slices).alias("slice"))
    return alone(placed.join(large, "id"), F.col("key"), F.col("slice"))


def cross_pieces(large: DataFrame, labels: DataFrame, bands: int, rows: int) -> DataFrame:
    """Pieces with every pair of nodes that shares a bucket and that ``labels(node, label)`` leaves in different components.

    Only buckets with nodes of several components count; they connect nodes
    to clusters. Blocks of a cluster's largest component meet the blocks of all
    others, not each other.
    """
    tied = large.select("id", "sig").join(labels.withColumnRenamed("node", "id"), "id", "left")
    tied = materialise(tied.select("id", "sig", F.coalesce("label", "id").alias("comp")), "tied")
    keys = band_keys(tied, bands, rows, ["comp"])
    open_ = keys.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("id").alias("a")).where("lo < hi").select("key", "a")
    edges = keys.join(materialise(open_, "open"), "key").where("a <> id").select("a", F.col("id").alias("b")).distinct()
    clusters = components(materialise(edges, "shared")).select(F.col("node").alias("id"), F.col("label").alias("piece"))
    nodes = materialise(clusters.join(tied.select("id", "comp"), "id"), "open_nodes")
    sizes = nodes.groupBy("piece", "comp").agg(F.count("*").alias("n")).groupBy("piece")
    sizes = sizes.agg(F.max_by("comp", F.struct("n", "comp")).alias("largest"), F.max("n").alias("n"), F.sum("n").alias("total"))
    sizes = sizes.select(
        "piece", "largest", F.ceil((F.col("total") - F.col("n")) / BLOCK).cast("int").alias("few"), F.ceil(F.col("n") / BLOCK).cast("int").alias("many")
    )
    inside = F.col("comp") == F.col("largest")
    own = F.when(inside, F.col("few") + F.pmod(F.xxhash64("id"), "many")).otherwise(F.pmod(F.xxhash64("id"), "few")).cast("int")
    last = F.when(inside, F.col("few") - 1).otherwise(F.col("few") + F.col("many") - 1)
    placed = nodes.join(sizes, "piece").withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    placed = placed.select("id", "piece", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return placed.join(large.select("id", "sig", "text"), "id")


def linked_components(docs: DataFrame, signed: DataFrame, k: int, percent: int, miss: float, bands: int, rows: int) -> DataFrame:
    """(node, label) for nodes of ``signed(doc_id, id, sig)`` that link with another; node is the id."""
    keys = band_keys(signed.where("id is not null"), bands, rows)
    buckets = keys.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("key", "a")
    buckets = materialise(buckets, "buckets")
    shared = keys.join(buckets, "key").where("a <> id").select("a", F.col("id").alias("b")).distinct()
    clusters = components(materialise(shared, "shared")).withColumnsRenamed({"node": "id", "label": "cluster"})
    # One row of each node, whose text is found by its doc_id and, where rows
    # repeat a doc_id, by its words.
    members = signed.join(clusters, "id").groupBy("id", "cluster").agg(F.min(F.struct("doc_id", "check", "sig")).alias("r"))
    members = materialise(members.select("id", "cluster", "r.doc_id", "r.check", "r.sig"), "members").withColumnRenamed("doc_id", "rep")
    texts = docs.select("doc_id", "text").where("text is not null")
    active = members.join(texts, members["rep"].eqNullSafe(texts["doc_id"])).select("id", "check", "cluster", "sig", "text")

    @F.pandas_udf("boolean")
    def is_text_of(checks: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([word_ids(words_of(t.encode()))[1] == n for n, t in zip(checks, text, strict=True)], dtype=bool)

    active = materialise(active.where(is_text_of("check", "text")).drop("check"), "active")
    spark, verifier = docs.sparkSession, Verifier(k, percent, miss, bands, rows)
    sizes = materialise(active.groupBy("cluster").agg(F.count_distinct("id").alias("members")), "sizes")
    sized = active.dropDuplicates(["id"]).join(sizes, "cluster")
    groups = packed(active.count(), spark)
    links = materialise(verified_links(alone(sized.where(F.col("members") <= BLOCK), F.col("cluster")), verifier, groups), "links")
    large = materialise(sized.where(F.col("members") > BLOCK).select("id", "sig", "text"), "large")
    if large.isEmpty():
        return components(links)
    near = materialise(verified_links(bucket_pieces(large, bands, rows), verifier, groups), "links")
    far = materialise(verified_links(cross_pieces(large, components(near), bands, rows), verifier), "links")
    return components(materialise(links.unionByName(near).unionByName(far), "links"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    Links documents whose sets of k-word shingles have a Jaccard similarity of
    at least ``percent`` in a hundred; component_id is the smallest doc_id that
    is reachable over links, itself included. A text that is null or has no
    words has no shingles and links with nothing. Repeated rows share a
    component. A null doc_id never names a component unless the whole component
    has none; then component_id is null and kept is true. An empty table gives
    an empty result; other columns are ignored. Bands, and the posterior bounds
    of all looks together, each miss a link at exactly the threshold with a
    probability of at most ``miss``, as far as MinHash values are independent.
    Texts of equal words are told by a 128-bit cryptographic digest.
    """
    bands, rows = banding(docs.count(), percent, miss)
    signed = materialise(signatures(docs, k, -(-bands * rows // BATCH) * BATCH), "signed", 500)
    signed = told_apart(signed)
    labels = linked_components(docs, signed, k, percent, miss, bands, rows)
    narrow = signed.select("doc_id", "n_shingles", "id")
    reps = narrow.where("id is not null").groupBy("id").agg(F.min("doc_id").alias("rep"))
    named = reps.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = materialise(named, "named")
    roots = named.groupBy("label").agg(F.min("rep").alias("root"), F.count("*").alias("n")).where("n > 1").select("label", "root")
    named = named.join(roots, "label", "left").select("id", F.coalesce("root", "rep").alias("root"))
    component = F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("root"))
    return (
        narrow.join(named, "id", "left")
        .withColumn("component_id", component)
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)
