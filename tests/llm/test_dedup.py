import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import corpus, frame, key_of, ordered, words
from pyspark.sql import functions as F

from isohyet.llm import anchors, near_dedup
from isohyet.llm.anchors import cut_runs, recurring, recurring_runs
from isohyet.llm.components import components
from isohyet.llm.exact_dedup import directory, exact_duplicates, may_repeat
from isohyet.llm.near_dedup import MISS, Verifier, banding, least_matches, near_duplicates, shingle_set, words_of
from isohyet.llm.substring_dedup import remove_repeats, without_repeats
from isohyet.llm.suffix_array import permuted_prefixes, suffix_array
from isohyet.llm.suffix_dedup import EMPTY_SHA, byte_spec, remove_seen

BIG = 1 << 62


def rank(doc_id):
    return BIG if doc_id is None else doc_id


def expected_exact(rows):
    body = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t or "")
    groups = defaultdict(list)
    for d, t in rows:
        groups[body(t)].append((-len(t or ""), rank(d), d))
    out = []
    for d, t in rows:
        g = groups[body(t)]
        keep = min(g)[2]
        out.append((d, keep, len(g), d == keep, hashlib.sha256(body(t).encode()).hexdigest()))
    return ordered(out)


@pytest.mark.parametrize("key", [F.xxhash64, lambda c: F.least(F.length(c), F.lit(3)).cast("long")], ids=["hash", "collisions"])
def test_exact_duplicates(spark, key):
    rows = corpus() if key is F.xxhash64 else corpus()[-14:]
    got = exact_duplicates(frame(spark, rows), key).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert ordered(got) == expected_exact(rows)


def test_exact_duplicates_over_many_buckets_and_slices(spark):
    rows = corpus() + [(None, "a hot text " * 20)] * 40 + [(i, "a hot  text " * 20) for i in range(900, 960)]
    got = exact_duplicates(frame(spark, rows), bucket_bytes=2000, slice_bytes=1000).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert ordered(got) == expected_exact(rows)


def test_bitmap_of_repeated_keys(spark):
    text, repeated = spark.range(20_000).select(F.col("id").alias("key")), spark.range(0, 20_000, 10).select(F.col("id").alias("key"))
    for bits, most in ((1 << 20, 2200), (1 << 10, 20_000)):
        got = {r["key"] for r in may_repeat(text, repeated, bits).collect()}
        assert got.issuperset(range(0, 20_000, 10)) and len(got) <= most


def test_exact_duplicates_of_nothing(spark):
    assert exact_duplicates(frame(spark, [])).collect() == []


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    cells = directory(keys, bucket_keys=300, max_depth=8)
    per_bucket = keys.withColumn("cell", F.shiftrightunsigned("key", 56).cast("int")).join(cells, "cell").groupBy("bucket").count()
    assert per_bucket.agg(F.max("count")).first()[0] <= 300 and per_bucket.count() > 8
    assert {r["depth"] for r in cells.select("depth").distinct().collect()} <= {4, 5}


def expected_near(rows, k, percent):
    sets = [shingle_set(words_of((t or "").encode()), k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(lambda: BIG)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], rank(d))
    name = lambda i: None if least[find(i)] == BIG else least[find(i)]
    return ordered((d, len(sets[i]), name(i), d == name(i)) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, k):
    rows = corpus()
    base = rows[33][1].split()
    rows += [(100 + i, " ".join([*base[: 3 * i], f"new{i}", *base[3 * i + 1 :]])) for i in range(25)]
    assert ordered(near_duplicates(frame(spark, rows), k).collect()) == expected_near(rows, k, 80)


def test_large_clusters_move_texts_in_proportion(spark, monkeypatch):
    """A chain of near copies, a group of copies of one text, and others: right links, and few moves of a text."""
    rnd = random.Random(8)
    moved = []
    plain = near_dedup.verified_links

    def counted(pieces, *rest):
        moved.append(pieces.count())
        return plain(pieces, *rest)

    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "verified_links", counted)
    chain, rows = [f"c{i}" for i in range(60)], []
    for i in range(160):
        chain[rnd.randrange(60)] = f"n{i}"
        rows.append((1000 + i, " ".join(chain)))
    base = [f"h{i}" for i in range(80)]
    rows += [(2000 + i, " ".join([*base, f"t{i}"])) for i in range(160)]
    rows += [(i, " ".join(f"r{rnd.randrange(300)}" for _ in range(40))) for i in range(60)]
    rnd.shuffle(rows)
    assert ordered(near_duplicates(frame(spark, rows)).collect()) == expected_near(rows, 5, 80)
    assert len(moved) == 3 and sum(moved) <= (near_dedup.ROUNDS + 6) * len(rows)


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    assert ordered(near_duplicates(frame(spark, [(1, None), (2, "")])).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_posterior_bounds():
    assert least_matches(64, 0.8, 1e-6) < 0.8 * 64 < least_matches(64, 0.8, 0.9)
    for n in (100, 10**6, 10**10):
        bands, rows = banding(n, 80)
        assert (1 - 0.8**rows) ** bands <= 1.0001e-6 and n * bands * 0.07**rows <= 0.5


def test_all_looks_share_one_miss_probability():
    for n in (100, 10**6):
        bands, rows = banding(n, 80)
        assert (1 - 0.8**rows) ** bands <= 1.0001e-6
        v = Verifier(5, 80, MISS, bands, rows)
        lost = 0.0
        for look, need in zip(v.steps, v.need, strict=True):
            assert 0 < need < 0.8 * look
            lost += sum(math.comb(look, k) * 4**k for k in range(need)) / 5**look
        assert lost <= 1.0001e-6


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 90), (90, 100), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(21), 0), 90: 90, 100: 90}


def expected_words(rows, length):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in texts for i in range(len(w) - length + 1))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return ordered(out)


def test_repeated_words(spark):
    assert ordered(remove_repeats(frame(spark)).collect()) == expected_words(corpus(), 35)


def test_repeated_words_where_anchors_are_split(spark):
    assert ordered(remove_repeats(frame(spark), shard_contents=0).collect()) == expected_words(corpus(), 35)


def test_matches_are_extended_both_ways(spark):
    # The same 40 words in changing company, one overlap short of the threshold, and a repeat inside one text.
    rnd = random.Random(9)
    some = lambda n: words(rnd, n, 100_000)
    shared, short = some(40), some(34)
    rows = [(i, " ".join([*some(rnd.randrange(50)), *shared[: 40 - i % 6], *some(rnd.randrange(50))])) for i in range(12)]
    rows += [(20 + i, " ".join([*some(9), *short, *some(9)])) for i in range(3)] + [(30, " ".join(shared[2:37] * 3 + some(5)))]
    got = without_repeats(frame(spark, rows)).collect()
    assert ordered(tuple(r)[:4] for r in got) == expected_words(rows, 35)
    texts = {r["doc_id"]: r["kept_text"] for r in got}
    assert texts[20] is None and len(texts[0].split()) == len(rows[0][1].split()) - 40


def test_repeated_words_of_nothing(spark):
    assert remove_repeats(frame(spark, [])).collect() == []


def expected_bytes(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    first = {}
    for (d, _), t in zip(rows, texts, strict=True):
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            first[w] = min(first.get(w, BIG), rank(d))
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < rank(d):
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return ordered(out)


@pytest.mark.parametrize("shard_contents", [20_000, 0], ids=["shards", "split"])
def test_seen_bytes(spark, shard_contents):
    assert ordered(remove_seen(frame(spark), shard_contents=shard_contents).collect()) == expected_bytes(corpus(), 50)


def common_passages(letters, joint):
    """One passage in changing company, with parts of it and parts of the company shared, and texts of short periods."""
    rnd = random.Random(21)
    some = lambda n: [rnd.choice(letters) for _ in range(n)]
    passage, company = some(70), [some(60) for _ in range(6)]
    rows = [(i, joint.join([*some(9), *rnd.choice(company)[rnd.randrange(40) :], *passage[rnd.randrange(30) :], *rnd.choice(company)[: rnd.randrange(60)], *some(9)])) for i in range(60)]
    periods = [letters[:1], letters[:7], letters[3:6]]
    return rows + [(100 + i, joint.join([*some(i % 4), *(periods[i % 3] * 60)[: 90 + 11 * (i % 5)], *some(i % 2)])) for i in range(30)]


@pytest.mark.parametrize("shard_contents", [8192, 12, 0])
def test_split_anchors_of_common_passages(spark, shard_contents):
    rows = common_passages([chr(97 + i) for i in range(26)], "")
    assert ordered(remove_seen(frame(spark, rows), shard_contents=shard_contents).collect()) == expected_bytes(rows, 50)
    rows = common_passages([f"w{i}" for i in range(300)], " ")
    assert ordered(remove_repeats(frame(spark, rows), shard_contents=shard_contents).collect()) == expected_words(rows, 35)


@pytest.mark.parametrize("period", ["a", "abcdefg"])
def test_seen_bytes_of_long_periods(spark, period):
    # Runs are cut at fixed steps from where they begin, which differ here; a text of other bytes before and after.
    rows = [(i, "x" * i + (period * 200_000)[: 150_000 + 40_000 * i] + f"tail {i}") for i in range(3)]
    assert ordered(remove_seen(frame(spark, rows)).collect()) == expected_bytes(rows, 50)


def seeds_in_changing_company():
    """Texts that share stretches of 28 bytes, so seeds but no window; two of them share a window as well."""
    rnd = random.Random(13)
    some = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    shared, window = [some(28) for _ in range(9)], some(50)
    return [(i, "".join(some(60) + x for x in shared) + some(60) + (some(20) + window + some(20) if i in (7, 11) else "")) for i in range(40)]


def test_seeds_that_meet_by_chance_list_no_runs(spark):
    rows = seeds_in_changing_company()
    texts = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc long").repartition(3)
    spec = byte_spec(50, 20)
    listed = recurring_runs(texts, spec, recurring(texts, spec, False), False).collect()
    assert {r["doc"] for r in listed} == {7, 11}
    assert ordered(remove_seen(frame(spark, rows)).collect()) == expected_bytes(rows, 50)


def test_runs_are_listed_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(anchors, "PASS_BYTES", 512)
    rows = corpus()
    texts = spark.createDataFrame([(t, i) for i, (_, t) in enumerate(rows)], "text string, doc long")
    found = recurring(texts, byte_spec(50, 20), False)
    assert len(found.passes()) > 2 and found.passes()[-1][1] == found.parts
    assert ordered(remove_seen(frame(spark, rows)).collect()) == expected_bytes(rows, 50)


@pytest.mark.parametrize(("length", "gram"), [(50, 20), (50, 19), (31, 31), (20, 5)])
def test_equal_windows_share_a_key(length, gram):
    rnd = random.Random(3)
    base = bytes(rnd.choice(b"abcd") for _ in range(200))
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(9))) + base[rnd.randrange(60) : rnd.randrange(100, 200)] + bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(90))) for _ in range(80)]
    texts += [b"q" * i + b"abcabcabd" * (9 + i % 3) + b"z" * (i % 50) for i in range(20)] + [b"k" * (40 + i) for i in range(20)] + [b"", b"k" * 70_000 + base]
    keys_of = {}
    for first, lot in anchors.chunks(texts, byte_spec(length, gram)):
        found = anchors.runs(lot, byte_spec(length, gram), anchors.Powers(), False)
        for j in range(len(found.text)):
            text, keys = lot[found.text[j]], frozenset(found.key[found.run == j].tolist())
            for i in range(found.first[j], min(found.last[j], found.first[j] + 200) + 1):
                keys_of.setdefault(text[i : i + length], {}).setdefault(first + int(found.text[j]), set()).update(keys)
    shared = [list(x.values()) for x in keys_of.values() if len(x) > 1]
    assert len(shared) > 100 and all(a & b for x in shared for a in x[:4] for b in x[-4:])


def test_runs_are_cut():
    first, last = cut_runs(np.array([5] * 10 + [6] + [5] * 4, np.uint64), 4)
    assert first.tolist() == [0, 4, 8, 10, 11] and last.tolist() == [3, 7, 9, 10, 14]


def test_seen_bytes_of_ids_that_are_no_numbers(spark):
    rows = [(d, t) for d, t in corpus() if d is not None and d < 60]
    got = remove_seen(frame(spark, rows).withColumn("doc_id", F.format_string("d%03d", "doc_id"))).collect()
    assert ordered((int(r[0][1:]), *r[1:]) for r in got) == expected_bytes(rows, 50)


def test_seen_bytes_of_nothing(spark):
    assert remove_seen(frame(spark, [])).collect() == []
    assert tuple(remove_seen(frame(spark, [(1, None)])).first()) == (1, 0, 0, 0, EMPTY_SHA)


def test_suffix_arrays():
    rng = np.random.default_rng(2)
    for trial in range(60):
        text = rng.integers(97, 97 + 1 + trial % 3, trial).astype(np.uint8)
        raw, sa = text.tobytes(), suffix_array(text).tolist()
        assert sa == sorted(range(len(raw)), key=lambda i: raw[i:])  # noqa: B023
        if not raw:
            continue
        shared = permuted_prefixes(text, np.array(sa), 50)
        for a, b in zip(sa, sa[1:], strict=False):
            n = 0
            while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert shared[b] == min(n, 50)


def test_row_keys_sort_nulls():
    assert key_of((None, 1)) < key_of((0, 1))


def test_suffix_arrays_of_runs_and_periods():
    """Runs of one character and short periods take no round per byte."""
    rng = random.Random(4)
    texts = [b"a" * n for n in (0, 1, 2, 199)] + [b"ab" * 90, b"abcdefg" * 40, b"a" * 50 + b"b" + b"a" * 50, b"b" * 30 + b"a" * 30 + b"c" * 30]
    texts += [b"".join(bytes([rng.choice(b"ab\x00\xff")]) * rng.randint(1, 30) for _ in range(rng.randint(1, 9))) for _ in range(200)]
    for text in texts:
        assert suffix_array(np.frombuffer(text, np.uint8)).tolist() == sorted(range(len(text)), key=lambda i: text[i:]), text
    began = time.process_time()
    for text in (b"a" * 2_000_000, b"abcdefg" * 300_000, (b"a" * 1_000_000 + b"b") * 2):
        array = suffix_array(np.frombuffer(text, np.uint8))
        assert len(array) == len(text) and len(np.unique(array)) == len(text)
    assert time.process_time() - began < 60
