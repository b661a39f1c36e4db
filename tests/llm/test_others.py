import base64
import gzip
import hashlib
import io
import random
import re
import urllib.parse
import zlib

import pytest
from fixtures import EXTRA, corpus, frame, ordered
from pyspark.sql import functions as F

import corpus_pipeline
from isohyet.llm import decontamination, language_id, mixing, secrets, url_filter, warc
from isohyet.llm.common import fresh_path
from isohyet.llm.near_dedup import shingle_set


def languages(n=120):
    rnd = random.Random(3)
    parts = {"en": ["the", "and", "ing", "tion", "th"], "de": ["sch", "ung", "ein", "ü", "keit"], "fr": ["eau", "que", "è", "ment", "ou"]}
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join("".join(rnd.choices(parts[lang], k=2)) for _ in range(30)), lang))
    return rows


def test_language_id(spark):
    rows = [*languages(), (500, None, "en"), (501, "", None), (502, "123 !!", "de"), (None, "the thing", "en"), (0, languages()[0][1], "en")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = language_id.identify_languages(df).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert all(by[i]["lang_pred"] == lang and 0 < by[i]["score"] <= 1 for i, _, lang in languages())
    assert {by[i]["lang_pred"] for i in (500, 501, 502)} == {"und"} and by[None]["held_out"] is False
    assert by[7]["held_out"] == (zlib.crc32(b"7") % 5 == 0)
    # lang takes no part in a prediction
    swapped = language_id.identify_languages(df.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))))
    assert ordered(swapped.collect()) == ordered(got)
    kept = language_id.keep_identified(df)
    assert kept.columns == df.columns and {500, 501, 502}.isdisjoint({r["doc_id"] for r in kept.collect()})


def test_language_id_without_training(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language_id.identify_languages(df).first()["lang_pred"] == "und"
    assert language_id.identify_languages(df.limit(0)).collect() == []


def test_mixing(spark):
    rows = [(i, "w " * (1 + (i * 37) % 90), "abcdef"[i % 6] if i % 7 else None) for i in range(400)] + [(900, None, "a"), (901, "", "z"), (5, "again and again", "b")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, target int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and ordered(r["doc_id"] for r in []) == []
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert all(r["source_size"] == sizes[r["source"]] for r in got)
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = dict(zip(order, [5, 2, 1] * 5, strict=False))
    want, total = {}, 1.5 * sum(sizes.values())
    open_, left = set(order), total
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 2 * sizes[s]
            left -= want[s]
        open_ -= over
    for s in order:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 0.02 * want[s] + 2
    assert ordered((r["doc_id"], r["copies"]) for r in mixing.mix(df).collect()) == ordered((r["doc_id"], r["copies"]) for r in got)


def test_mixing_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(blank).collect()] == [0, 0]


PAGES = [(1, "http://a/1", "x" * 1200), (2, "http://a/2", "x" * 1200), (3, None, "x" * 1200), (4, "http://a/4", "short"), (5, "http://a/5", "short"), (6, "http://a/6", None)]
PAGES += [(7, "http://ü/7", "é" * 600), (8, "u", "é" * 600), (8, "u", "é" * 600), (None, "n", "x" * 1200), (None, "n", "z" * 1100), (None, None, "z" * 1100), (9, "long", "y" * 300_000)]


def test_warc_round_trip(spark):
    df = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id long, url string, html string, digest int")
    got = warc.round_trip(df, fresh_path(spark, "warc")).collect()
    assert all(r["valid"] for r in got)
    last = {}
    for i, _, html in PAGES:
        body = (html or "").encode()
        if len(body) >= 1000 and i is not None:
            last[body] = max(last.get(body, -1), i)
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        revisit = body in last and last[body] != i
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last[body] if revisit else None))
    as_int = lambda x: None if x is None else int(x)
    assert ordered((as_int(r["page_id"]), r["payload_length"], r["payload_digest"], r["type"], as_int(r["refers_to"])) for r in got) == ordered(want)


def test_warc_of_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string"), fresh_path(spark, "warc")).collect() == []


def test_warc_members_and_damage():
    one, two = (warc.record("response", f"<{i}>", "u", b"payload" * i, {}) for i in (1, 9000))
    found = list(warc.members(io.BytesIO(one + two), piece=7))
    assert [o for o, _ in found] == [0, len(one)] and all(warc.parse(c)["valid"] for _, c in found)
    assert warc.parse(found[1][1])["payload"] == b"payload" * 9000
    assert not warc.parse(found[0][1].replace(b"payload", b"pAyload"))["valid"]
    assert gzip.decompress(one).startswith(b"WARC/1.1\r\n")
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(one[:-5])))


def naive_base(text):
    import re

    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [("assign", *m.span()) for m in re.finditer(assign, text, re.ASCII) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]


def test_secret_base_spans():
    rnd = random.Random(1)
    bits = ["password", "Token = ", "api_key:", ":", "=", " ", '"', "AKIA", "ABCDEFGHIJ123456", "deadbeef0123", "é", "abc", "secret='", "ſecret=longvalue"]
    for _ in range(500):
        text = "".join(rnd.choices(bits, k=12))
        found = [x[:3] for x in secrets.find(text) if x[4] == ""]
        assert sorted(found) == sorted(naive_base(text))


def test_secret_layers():
    secret = "password=hunter2secret"
    b64 = base64.b64encode(secret.encode()).decode()
    zipped = base64.b64encode(gzip.compress(secret.encode())).decode()
    double = base64.b64encode(urllib.parse.quote(b64).encode()).decode()
    unicode = "".join(f"\\u{ord(c):04x}" for c in secret)
    for blob, path in ((b64, "base64"), (zipped, "base64>gzip"), (double, "base64>base64"), (unicode, "unicode"), (urllib.parse.quote(secret, safe=""), "url")):
        text = f"é before {blob} after"
        found = [x for x in secrets.find(text) if x[0] == "assign" and x[3] == secret]
        assert len(found) == 1, blob
        kind, start, end, _, layer = found[0]
        assert layer == path and text[start:end].strip("=") in blob and text.index(blob) <= start < end <= text.index(blob) + len(blob)
    assert secrets.find("token%3Dabc%2564ef")[0][1:3] == (0, 18)  # %2564 unwraps to d
    assert secrets.find("%25" * 50) == [] and secrets.find(None) == [] and secrets.find("") == []


def test_secret_layers_that_repeat():
    secret = "password=hunter2secret"
    b64 = base64.b64encode(secret.encode()).decode()
    zipped = base64.b64encode(gzip.compress(secret.encode(), mtime=0)).decode()
    double = base64.b64encode(urllib.parse.quote(b64).encode()).decode()
    for blob in (b64, zipped, double):
        text = f"é {blob} and {blob} %2B {blob}"
        spans = [x[1:3] for x in secrets.find(text) if x[0] == "assign" and x[3] == secret]
        places = [m.start() for m in re.finditer(re.escape(blob), text)]
        assert len(spans) == len(places) == 3
        assert all(p <= start < end <= p + len(blob) for p, (start, end) in zip(places, spans, strict=True))
    # Twice within one outer layer, which itself stands twice.
    outer = base64.b64encode(f"{b64}\n{b64}".encode()).decode()
    spans = [x[1:3] for x in secrets.find(f"{outer} {outer}") if x[3] == secret]
    assert len(set(spans)) == len(spans) == 4
    assert [b <= len(outer) for _, b in spans] == [True, True, False, False]


def test_secret_table(spark):
    df = frame(spark, [(1, "token: abcdef1"), (2, None), (None, ""), (1, "token: abcdef1")])
    got = secrets.find_secrets(df).collect()
    assert sorted((r["doc_id"] or 0, len(r["spans"])) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 0)]
    assert secrets.find_secrets(df.limit(0)).collect() == []


def test_decontamination(spark):
    rnd = random.Random(9)
    item = lambda n: " ".join(f"q{rnd.randrange(10**6)}" for _ in range(n))
    bench = [(1, item(20)), (2, item(60)), (3, "one"), (4, None), (5, ""), (None, item(12)), (2, item(6))]
    rows = corpus()
    long_item, part = bench[1][1].split(), bench[0][1].split()
    rows += [(200, f"x {bench[0][1].upper()}! y"), (201, " ".join(long_item[:52])), (202, " ".join(long_item[:30])), (203, f"{bench[5][1]} {bench[6][1]}"), (204, " ".join(part[:10] + ["gap"] + part[10:]))]
    b = spark.createDataFrame([(*x, 1) for x in bench], "item_id long, text string, row int")
    got = decontamination.contaminated(frame(spark, rows), b).select("doc_id", "item_id", "item_shingles", "found").collect()
    want = []
    for d, t in rows:
        own = shingle_set(decontamination.plain_words(t), 5)
        for i, q in bench:
            theirs = shingle_set(decontamination.plain_words(q), 5)
            if theirs and 100 * len(theirs & own) >= 80 * len(theirs):
                want.append((d, i, len(theirs), len(theirs & own)))
    assert ordered(got) == ordered(want) and {w[0] for w in want} >= {8, 9, 200, 201, 203}
    assert decontamination.contaminated(frame(spark, []), b).collect() == []
    assert decontamination.contaminated(frame(spark), b.limit(0)).collect() == []


URLS = [(1, "https://a.Example.org/es/1?x#y"), (2, "http://example.org/en/12"), (3, "http://x.org"), (4, "http://x.org/"), (5, "http://com/fr/a"), (6, "http://xcom/de/a")]
URLS += [(7, "http://y.com/de/a"), (8, None), (9, "nothing"), (10, "a://b://c.org/x"), (1, "https://a.Example.org/es/1?x#y"), (None, "http://example.org/en/2")]


def test_url_rules(spark):
    df = spark.createDataFrame([(*u, "r") for u in URLS], "page_id long, url string, rule string")
    labels = spark.createDataFrame([(1, True), (2, None), (None, True)], "page_id long, bad boolean")
    got = {r["page_id"]: tuple(r)[1:5] for r in url_filter.judge_urls(df, labels).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[2][2:] == ("example.org/en/1", "block")
    assert got[3] == ("x.org", "", None, "allow") and got[4][2:] == ("org/", "allow") and got[5][2:] == ("com/fr/", "allow")
    assert got[6] == ("xcom", "/de/a", None, "allow") and got[7][2:] == ("com/de/", "block")
    assert got[8] == got[9] == ("", "", None, "allow") and got[10][0] == "b:" and got[None][2] == "org/"
    assert url_filter.judge_urls(df, labels).count() == len(URLS) and url_filter.judge_urls(df.limit(0), labels).collect() == []


def test_url_rules_from_labels(spark):
    rows = [(i, f"http://{'spam' if i % 4 == 0 else 'fine'}{i % 3}.net/{'buy' if i % 8 < 2 else 'read'}/{i}") for i in range(800)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    labels = df.select("page_id", F.col("url").rlike("spam.*/buy/").alias("bad"))
    got = url_filter.judge_urls(df, labels)
    wrong = got.join(labels, "page_id").where((F.col("verdict") == "block") != F.col("bad"))
    assert wrong.count() == 0 and got.where("mined_rule is not null").count() == 100


def test_mined_rules_against_brute_force(spark):
    from itertools import combinations

    rows = [(f"http://h{i % 5}.net/{'abc'[i % 3]}/{'xy'[i % 2]}{'' if i % 7 else '/deep'}", i % 5 == 0 and i % 3 == 1 or i % 11 == 0) for i in range(900)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    sets = [(frozenset(r["t"]), r["bad"]) for r in df.select(url_filter.tokens(F.col("url")).alias("t"), "bad").collect()]
    n_bad = sum(b for _, b in sets)
    least = max(0.6, 1 - (1 - n_bad / len(sets)) / 2)
    names, good = sorted(set().union(*(t for t, _ in sets))), {}
    for size in (1, 2, 3):
        for a in combinations(names, size):
            hit = [b for t, b in sets if t.issuperset(a)]
            if sum(hit) >= 25 and sum(hit) / len(hit) >= least and not any(g < set(a) and c >= sum(hit) / len(hit) for g, c in good.items()):
                good[frozenset(a)] = sum(hit) / len(hit)
    judged = {r["url"] for r in url_filter.matched(df, url_filter.mine_rules(df)).collect()}
    assert good and judged == {u for (u, _), (t, _) in zip(rows, sets, strict=True) if any(t >= g for g in good)}


def test_a_long_url_that_repeats_is_one_rule_item(spark):
    long = "http://long.net/" + "/".join(f"{a}{b}x" for a in "abcdefgh" for b in "abcde") + "?" + "&".join(f"q{a}=1" for a in "abcdefgh")
    rows = [(long, i % 10 > 0) for i in range(10_000)] + [(f"http://other.net/{i}", False) for i in range(500)] + [(None, True), ("", None)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    rules = url_filter.mine_rules(df)
    assert rules.count() == 0  # bad rows are the rule here, not the exception
    rules = url_filter.mine_rules(df, min_gain=0.0)
    assert [len(r["antecedent"]) for r in rules.collect()] == [1] and url_filter.matched(df, rules).count() == 1


def test_pipeline(spark, tmp_path):
    rows = [(1000 + i, t) for i, t, _ in languages()]
    docs = frame(spark, [*corpus(), *rows, (2000, rows[0][1]), (2001, rows[1][1] + " more"), (2002, "und 77 " + " ".join(f"q{j}x" for j in range(30)))])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") >= 1000, F.element_at(F.array(F.lit("en"), F.lit("de"), F.lit("fr")), (F.col("doc_id") % 3 + 1).cast("int"))).otherwise("en"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame([(1, " ".join(f"Q{j}x" for j in range(20)))], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    df, ids = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, df, str(tmp_path)).write.parquet(path)
        df = spark.read.parquet(path)
        if i < 4:
            assert set(df.columns) == {"doc_id", "text", "lang", "source", *EXTRA}
        ids[name] = {r["doc_id"] for r in df.select("doc_id").collect()}
    assert {5, 6, 7, 61, 63}.isdisjoint(ids["language_id"]) and 1000 in ids["language_id"]
    assert ids["language_id"] - ids["exact_dedup"] == {1, 2, 2000}  # 3 is the longest of its group
    assert ids["exact_dedup"] - ids["near_dedup"] == {4, 9, 51, 52, 2001}
    assert ids["near_dedup"] - ids["decontamination"] == {2002}
    assert ids["mixing"] == ids["decontamination"]
    assert ordered(corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "taken").collect()) == ordered(df.select("doc_id", "taken").collect())


def test_mixing_of_many_sizes(spark):
    from isohyet.llm import mixing

    n = 30_000
    groups = spark.range(1, n).select(F.lit("a").alias("source"), F.col("id").alias("size"), F.lit(3).cast("long").alias("n"), (0.3 + F.pmod("id", F.lit(7)) / 10).alias("rate"))
    got = mixing.whole_copies(groups).agg(F.sum(F.col("size") * F.col("group_copies")), F.sum(F.col("size") * F.col("n") * F.col("rate")), F.max("group_copies"), F.count("*")).first()
    assert abs(got[0] - got[1]) <= 100 and got[2] <= 6 and got[3] == n - 1


def test_warc_headers_that_are_damaged(tmp_path, spark):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    assert warc.parse(good)["valid"]
    bad = (good.replace(b": 2", b": x"), good.replace(b": 2", b": -1"), good.replace(b"Content-Length: 2\r\n", b""), good.replace(b"WARC-Type", b"WARC-Payload-Digest: sha1:!!\r\nWARC-Type"), b"", b"\xff\xfe")
    assert [warc.parse(x)["valid"] for x in bad] == [False] * len(bad)
    path = tmp_path / "damaged.warc.gz"
    path.write_bytes(warc.record("response", "<urn:x>", "u", b"abc", {}) + b"no gzip at all")
    rows = warc.read_archives(spark.createDataFrame([(str(path),)], "path string"), f"file://{tmp_path}").collect()
    assert sorted((r["valid"], r["payload"]) for r in rows) == [(False, None), (True, bytearray(b"abc"))]


def test_secrets_in_odd_layers():
    import bz2
    import gzip
    import lzma

    secret = "password=hunter2secret"
    blob = lambda data: base64.b64encode(data).decode()
    texts = {
        "url, a byte that is no UTF-8": "%ff" + "".join(f"%{b:02x}" for b in secret.encode()),
        "base64 of UTF-16": blob(secret.encode("utf-16-le")),
        "base64 after a binary prefix": blob(b"\x80\xfe\x00\x91" * 3 + b"  " + secret.encode()),
        "two gzip members": blob(gzip.compress(b"nothing here ") + gzip.compress(secret.encode())),
        "bz2": blob(bz2.compress(secret.encode())),
        "xz in gzip": blob(gzip.compress(lzma.compress(secret.encode()))),
    }
    for name, text in texts.items():
        assert any(f[3].startswith(secret) for f in secrets.find(f"see {text} there")), name
    # Pieces of a long layer overlap, so that a secret over an edge is seen, and multi-byte characters do not lose a piece.
    data = ("é" * 70_001 + " " + secret + " ").encode() * 3
    assert {f[3] for f in secrets.find(blob(gzip.compress(data)), limit=70_001)} == {secret}


def test_secrets_in_a_long_text():
    text = "word " * 400_000 + "%70assword=hunter2secret" + " x" * 1000
    found = secrets.find(text)
    assert [(f[0], f[1], f[2]) for f in found] == [("assign", 2_000_000, 2_000_024)]


def test_language_stage_keeps_columns_that_clash(spark):
    from isohyet.llm.language_id import keep_identified

    docs = spark.createDataFrame([(i, "some words of a plain text", "en", i) for i in range(20)], "doc_id long, text string, lang string, _lang int")
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and sorted(r["_lang"] for r in kept.collect()) == list(range(20))


@pytest.mark.parametrize("header", ["HTTP/1.1 200 OK\r\nContent-Length: \u00b2", "HTTP/1.1 200 OK\r\nContent-Length: " + "1" * 5000, "HTTP/1.1 200 OK\r\nContent-Length: -3"])
def test_warc_http_lengths_that_are_damaged(header):
    block = header.encode("latin-1") + b"\r\n\r\nbody"
    head = f"WARC/1.1\r\nWARC-Type: revisit\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    assert warc.parse(head + block + b"\r\n\r\n")["valid"] is False


def test_warc_fields_that_are_damaged():
    good = "WARC/1.1\r\nWARC-Type: response\r\n{}\r\n\r\nok\r\n\r\n"
    assert warc.parse(good.format("Content-Length: 2").encode())["valid"]
    for fields in ("Content-Length: " + "2" * 5000, "Content-Length: 2\r\nWARC-Payload-Digest: sha1:\u00e9", "Content-Length: \u0662"):
        assert warc.parse(good.format(fields).encode())["valid"] is False


def test_warc_page_ids_of_any_text(tmp_path, spark):
    names = ["a\r\nContent-Length: 0", " spaced ", "100%41", "\u00e9: x", ""]
    pages = spark.createDataFrame([(n, "u", "same " * 400) for n in names], "page_id string, url string, html string")
    rows = warc.round_trip(pages, f"file://{tmp_path}/a").collect()
    assert sorted(r["page_id"] for r in rows) == sorted(names) and all(r["valid"] for r in rows)
    assert {r["refers_to"] for r in rows} == {None, max(names)}


def test_secrets_in_layers_of_bytes():
    import gzip

    secret = "password=hunter2secret"
    packed = gzip.compress((" " + secret + " ").encode())
    blob = lambda data: base64.b64encode(data).decode()
    deflated = zlib.compressobj(9, zlib.DEFLATED, -15)
    raw = deflated.compress(f"a note with {secret} in it".encode()) + deflated.flush()
    wide = blob(gzip.compress(bytes(random.Random(1).randrange(256) for _ in range(300)) + b" " + secret.encode()))
    texts = {
        "gzip in URL escapes": "".join(f"%{b:02x}" for b in packed),
        "gzip quoted as a URL quotes": urllib.parse.quote_from_bytes(packed),
        "gzip in string escapes": "".join(f"\\x{b:02x}" for b in packed),
        "gzip as a literal": repr(packed)[2:-1],
        "base64 wrapped at 76 columns": "\n".join(wide[i : i + 76] for i in range(0, len(wide), 76)),
        "wrapped with CRLF and indents": "\r\n  ".join(wide[i : i + 64] for i in range(0, len(wide), 64)),
        "text wrapped": "\n".join(blob(b"words before it and " + secret.encode() + b" and after it")[i : i + 24] for i in range(0, 84, 24)),
        "raw deflate": blob(raw),
        "after a path of one to four": [f"http://h/{'abcd'[:n]}/{blob(b'the ' + secret.encode())}" for n in (1, 2, 3, 4)],
        "gzip after a path": [f"http://h/{'abcd'[:n]}/{blob(packed)}" for n in (1, 2, 3, 4)],
    }
    for name, many in texts.items():
        for text in many if isinstance(many, list) else [many]:
            found = [f for f in secrets.find(f"see {text} there") if f[3].startswith(secret)]
            assert found and all(4 <= f[1] < f[2] <= 4 + len(text) for f in found), name


def test_wrapped_digits_map_to_their_places():
    secret = "password=hunter2secret"
    coded = base64.b64encode(b"0" * 30 + b" " + secret.encode() + b" " + b"1" * 30).decode()
    text = "key\n" + "\n".join(coded[i : i + 20] for i in range(0, len(coded), 20))
    kind, start, end, value, layer = next(f for f in secrets.find(text) if f[3] == secret)
    part = text[start:end].replace("\n", "")
    assert part in coded and abs(coded.index(part) - 31 * 4 // 3) <= 1 and len(part) <= len(secret) * 4 // 3 + 4


@pytest.mark.parametrize("limit", [1 << 20, 5000, 777])
def test_nested_streams_of_any_size(limit):
    import bz2
    import gzip
    import lzma

    rng = random.Random(7)
    filler = bytes(rng.randrange(97, 123) if i % 7 else 32 for i in range(60_000))
    data = filler + b" password=hunter2secret "
    for layers in ([gzip.compress], [gzip.compress, gzip.compress], [lzma.compress, gzip.compress], [gzip.compress, bz2.compress, zlib.compress], [bz2.compress, bz2.compress]):
        packed = data
        for pack in layers:
            packed = pack(packed)
        found = secrets.find(base64.b64encode(packed).decode(), limit)
        assert [f[3] for f in found] == ["password=hunter2secret"], (layers, limit)


def test_letters_beyond_the_second_plane():
    letters = language_id._letters()
    assert len(letters) == 0x110000 and len(language_id.ngrams("\U00030000\U00030001", letters)[0])
    assert not len(language_id.ngrams("\U0001f600 12", letters)[0])
