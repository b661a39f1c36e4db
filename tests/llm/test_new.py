"""Personal data, spelling variants and resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from isohyet.llm import prefix_crc, spelling
from isohyet.llm.personal_data import KINDS, base_spans, candidates, op11_personal_data, personal_data
from isohyet.llm.queries import ORACLES
from isohyet.llm.resampling import resample
from isohyet.llm.spelling import counted_words, grouped_spellings

DOCS = "doc_id long, text string, n_words string, word string"


def frame(spark, texts, ids=None):
    rows = [(i, t, "x", "y") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


# --- resampling


def plain_words(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", text) if w]


def test_crcs_of_all_ngrams(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcXYZ09 é中,.\n-_") for _ in range(rng.randint(0, 300))) for _ in range(80)]
    texts += ["q" * n + " z é" for n in (60, 63, 64, 65, 5000, 70000)] + ["", " ", "a", "a b " * 5000]
    for block in (3, 1 << 16):
        monkeypatch.setattr(prefix_crc, "BLOCK_WORDS", block)
        for text in texts:
            for longest in (1, 2, 3):
                w = plain_words(text)
                wanted = sorted(zlib.crc32(" ".join(w[i : i + k]).encode()) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
                blocks = list(prefix_crc.ngram_crcs(text.encode(), longest))
                assert sorted(int(c) for crcs, _ in blocks for c in crcs) == wanted and sum(n for _, n in blocks) == len(w)


def plain_resample(docs, target, longest, buckets, percent, min_words, seed):
    def features(text):
        w = plain_words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    s = Counter(b for _, text in docs for b in features(text))
    t = Counter(b for text in target for b in features(text))
    ns, nt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in range(buckets)}
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(text))])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("longest,buckets,percent", [(2, 10_000, 25), (3, 7, 50), (1, 70_000, 100)])
def test_resampling_against_plain_version(spark, longest, buckets, percent):
    rng = random.Random(2)
    vocabulary = ["alpha", "Beta", "gamma", "δέλτα", "e5", "x", "naïve", "中文"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None, "", " .,", "alpha " * 30_000]
    ids = [*range(62), 5, None]  # a repeated and a null doc_id
    target = [*texts[:3], None]
    got = resample(frame(spark, texts, ids), spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"), longest, buckets, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_resample(list(zip(ids, texts)), target, longest, buckets, percent, 20, 7)


def test_resampling_ties_and_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert resample(empty, empty).collect() == []
    texts = ["same words " * 20] * 9
    got = {tuple(r)[0]: r["rank"] for r in resample(frame(spark, texts, [4] * 9), empty, percent=50).collect()}
    assert got.keys() == {4}
    ranks = sorted(r["rank"] for r in resample(frame(spark, texts, [4] * 9), empty, percent=50).collect() if r["rank"])
    assert ranks == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        resample(empty, empty, buckets=0)


# --- spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_spellings(words, times=10):
    out, form = {}, {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x.encode()), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
        out[w] = [n, len(others), words[form[w]] if form[w] else None]
    rows = set()
    for w, (n, n_near, form_n) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, n_near, form_n))
    return rows


def some_words(seed, count):
    rng, words = random.Random(seed), {}
    while len(words) < count:
        w = "".join(rng.choice("abéÿ" if rng.random() < 0.6 else "abcdefghij×") for _ in range(rng.randint(1, 9)))
        words[w] = rng.choice([1, 2, 3, 20, 250, 3000])
    words |= {"abcdefgh" * 250: 2, "abcdefgh" * 250 + "i": 30, "abcdefgh" * 249 + "abcdefgi": 400}  # beyond single precision
    return words


@pytest.mark.parametrize("tile,pairs", [(2048, 8192), (5, 10**9), (2048, 1), (3, 200)])
def test_spellings_against_all_pairs(spark, monkeypatch, tile, pairs):
    monkeypatch.setattr(spelling, "TILE_WORDS", tile)
    words = some_words(tile + pairs, 350)
    got = grouped_spellings(spark.createDataFrame(list(words.items()), "word string, n long"), pairs_per_word=pairs).collect()
    assert len(got) == len(words) and {tuple(r) for r in got} == plain_spellings(words)


def test_counted_words_lose_letters(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Wunderbar", "ÉTONNANT", "colours", "short", "aaaaaaaa", "naïvetés"]) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    texts += [None, "", "x" * 9, "colours1colours_colours×colours", "y" * 100_000]
    ids = [*range(123), 3, None]
    wanted = Counter()
    for i, text in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                wanted[run] += 1
    got = counted_words(frame(spark, texts, ids)).collect()
    assert {r["word"]: r["n"] for r in got} == wanted and len(got) == len(wanted)


def test_spellings_of_nothing(spark):
    assert grouped_spellings(counted_words(spark.createDataFrame([], DOCS))).collect() == []


# --- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            check = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and check % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_against_plain_patterns():
    rng, found = random.Random(3), 0
    for _ in range(20_000):
        letters = rng.choice(["ab1.@-", "0123.. ", "0123456789 -", "+1()5. -6", "ab@.1+- 9%", "+0 1.2@-éa\n"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert base_spans(text) == plain_spans(text)
        found += len(base_spans(text))
        spans = [c[1:] for c in candidates(text, [b[1:] for b in base_spans(text)])]
        assert all(a[1] <= b[0] or a == b for a, b in zip(spans, spans[1:]))
        assert not any(s < e2 and s2 < e for s, e in spans for _, s2, e2 in base_spans(text))
    assert found > 1000


@pytest.mark.parametrize("text", ["a" * 10**6 + "@", "1" * 10**6, "1." * 10**5, "+" + "1" * 10**6, "a@" * 10**5, "@" * 10**6, "1 " * 10**5, "a:" * 10**5])
def test_long_runs_take_linear_time(text):
    assert candidates(text, []) is not None and base_spans(text) is not None


def spans_of(rows):
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in rows}


def test_contexts_find_what_the_patterns_miss(spark):
    seeds = [f"please ring extension desk +1 (212) 555-01{i:02d} for help" for i in range(12)]
    plain = [f"we counted 55501{i:02d}9 of them" for i in range(12)]
    unseen = ["please ring extension desk 555-867-5309 for help", "or reach 5558675309 at once", "write 5550001119 instead"]
    docs = frame(spark, seeds + plain + unseen)
    got = spans_of(personal_data(docs).collect())
    assert all(got[i] == [("phone", 27, 44)] for i in range(12))
    assert all(got[i] == [] for i in range(12, 24))  # numbers whose context no seed shares
    assert got[24] == [("phone", 27, 39)]
    assert got[25] == [("phone", 9, 19)]  # the same digits elsewhere
    assert got[26] == []


def test_rounds_pass_on_what_was_found(spark):
    texts = [f"badge line +1 212 555 01{i:02d} end" for i in range(8)]
    texts += [f"badge line 800555{i:04d} stop" for i in range(4)]  # found from the seeds' context
    texts += [f"hotline code 800555{i:04d} stop" for i in range(4)] + ["hotline code 9005550000 now"]  # found from those
    docs = frame(spark, texts)
    one, three = (spans_of(personal_data(docs, rounds=n).collect()) for n in (1, 3))
    assert one[16] == [] and three[16] == [("phone", 13, 23)]


def test_common_contexts_are_no_evidence(spark):
    texts = ["of the word of the thing of the place"] * 30 + [f"of the +1 212 555 01{i:02d}" for i in range(9)] + ["of the 2125550999"]
    assert spans_of(personal_data(frame(spark, texts)).collect())[39] == []


def test_personal_data_edges(spark):
    texts = [None, "", "x", "+1 212 555 0100", "a@b.c", "a@b.c", "0.0.0.255 é 4111 1111 1111 1111", "word " * 50_000 + "a@b.co"]
    ids = [1, 2, 3, 4, 5, 5, None, 8]
    rows = personal_data(frame(spark, texts, ids)).collect()
    assert len(rows) == 8 and sorted(len(r["spans"]) for r in rows) == [0, 0, 0, 1, 1, 1, 1, 2]
    assert [s["kind"] for r in rows if r["doc_id"] is None for s in r["spans"]] == ["ip", "card"]
    assert [s["start"] for r in rows if r["doc_id"] == 8 for s in r["spans"]] == [250_000]
    assert personal_data(spark.createDataFrame([], DOCS)).collect() == []


def test_query_counts_base_spans(spark, tmp_path):
    frame(spark, ["a@b.c 4111111111111111", None]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in op11_personal_data(spark, str(tmp_path)).collect()}
    assert (rows[0]["n_email"], rows[0]["n_card"], rows[0]["spans"]) == (1, 1, "email:0:5,card:6:22")
    assert rows[0]["base_sha256"] == hashlib.sha256(b"email:0:5,card:6:22").hexdigest() and rows[1]["spans"] == ""
    assert KINDS == ("email", "ip", "card", "phone") and {"op12_spelling", "op13_resampling"} <= ORACLES.keys()
