"""A small corpus with nulls, empties, copies, near copies, ties, repeated rows and clashing columns."""

import random

EXTRA = ("key", "size", "node", "n", "label", "anchor", "rank", "row", "id", "chain", "digest", "content", "copies", "items")


def words(rnd, n, vocabulary=400):
    return [f"w{rnd.randrange(vocabulary)}{'abcde'[rnd.randrange(5)]}" for _ in range(n)]


def corpus():
    rnd = random.Random(5)
    passage = " ".join(words(rnd, 60))
    base = words(rnd, 120)
    rows = [(i, " ".join(words(rnd, rnd.randrange(20, 150)))) for i in range(10, 40)]
    rows += [(1, " ".join(base)), (2, " ".join(base)), (3, "  ".join(base) + "\n"), (4, " ".join([*base[:60], "changed", *base[61:]]))]
    rows += [(5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "ONE"), (60, "one two"), (61, "…"), (62, "éé 12"), (63, "12 34 56")]
    rows += [(50, f"start {passage} end"), (51, f"{passage} other end"), (52, f"a b c {passage}"), (53, "abc " * 50), (54, "x" * 120)]
    rows += [(55, " ".join(words(rnd, 8000, 100_000))), (50, f"start {passage} end"), (None, "a null id " + passage), (None, None)]
    return rows


def frame(spark, rows=None, extra=EXTRA):
    rows = corpus() if rows is None else rows
    schema = "doc_id long, text string, lang string, source string" + "".join(f", `{c}` int" for c in extra)
    full = [(d, t, ("en", "de", None)[i % 3], ("a", "a", "b", None)[i % 4], *([i] * len(extra))) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(3)


def key_of(row):
    return tuple((x is not None, x) for x in row)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=key_of)
