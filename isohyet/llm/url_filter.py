"""URL filters: explicit host and path rules, and rules mined from labels.

Spark's FP-growth mines combinations of URL tokens that go with a bad label.
Rules that pass the support and confidence thresholds form an inverted index
from token to rule; a URL is blocked where it has every item of a rule.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table

HOST = "^.*?://([^/?#]*)"
PATH = "^.*?://[^/?#]*([^?#]*)"

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path. Both are empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return _ascii_lower(F.regexp_extract(url, f"(?s){HOST}", 1)), F.regexp_extract(url, f"(?s){PATH}", 1)


def explicit_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path together, and its verdict; both null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones win
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host and its labels, path segments (numbers as one token), query names."""
    host, path = split_url(url)
    whole = F.coalesce(url, F.lit(""))
    labels = F.filter(F.split(host, "\\."), lambda x: x != "")
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    names = F.filter(F.split(F.regexp_extract(whole, "\\?([^#]*)", 1), "&"), lambda x: x != "")
    return F.array_distinct(
        F.concat(
            F.array(F.concat(F.lit("scheme="), F.regexp_extract(whole, "^(.*?)://", 1)), F.concat(F.lit("host="), host)),
            F.transform(labels, lambda x: F.concat(F.lit("label:"), x)),
            F.transform(steps, lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "0"))),
            F.transform(names, lambda x: F.concat(F.lit("query:"), F.regexp_extract(x, "^([^=]*)", 1))),
        )
    )


def mine_rules(
    labelled: DataFrame, min_rows: int = 25, min_confidence: float = 0.6, min_gain: float = 0.5, max_tokens: int = 3
) -> DataFrame:
    """Rules ``(rule_id, antecedent, confidence, lift, support, tokens)`` whose consequent is the bad label.

    ``labelled`` has url and bad (boolean); rows with a null label or url are
    not learned from. A rule needs ``min_rows`` bad rows, a number that is the
    same at every size of the table, so that chance does not make rules of a few
    rows; ``min_confidence``; and a share of rows that are not bad that is
    smaller than the table's by ``min_gain``. It has at most ``max_tokens``
    items and is pruned where a more general rule has at least its confidence.

    FP-growth gets the bad rows and only what can matter after pruning: no item
    that every row has, and none that only bad rows have, which is a rule by
    itself. Tokens that stand in the same rows are one item; ``tokens`` lists
    them by item, and any of them stands for it. So a long URL that repeats does
    not multiply its token sets.
    """
    spark = labelled.sparkSession
    schema = "rule_id string, antecedent array<string>, confidence double, lift double, support double, tokens array<struct<item:string,tokens:array<string>>>"
    urls = labelled.where("bad is not null and url is not null").groupBy("url").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
    urls = materialise(urls.withColumn("token", tokens(F.col("url"))), "labelled_urls")
    total = urls.agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")).first()
    if (total["n_bad"] or 0) < min_rows:
        return spark.createDataFrame([], schema)
    base = total["n_bad"] / total["n"]
    least = max(min_confidence, 1 - (1 - base) * (1 - min_gain))
    pairs = urls.withColumn("token", F.explode("token"))
    same_rows = [F.bit_xor(F.xxhash64("url")).alias("h"), F.bit_xor(F.xxhash64("url", F.lit(1))).alias("h2"), F.count("*").alias("c")]
    stats = pairs.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"), *same_rows)
    stats = stats.where((F.col("n_bad") >= min_rows) & (F.col("n") < total["n"]))
    items = stats.groupBy("n", "n_bad", "h", "h2", "c").agg(F.array_sort(F.collect_list("token")).alias("tokens"))  # tokens of one url
    items = materialise(items.select(F.element_at("tokens", 1).alias("item"), "tokens", "n", "n_bad"), "items")
    sure = items.where("n_bad = n").select(F.array("item").alias("antecedent"), F.col("n_bad").alias("freq"), "n")
    mixed = items.where("n_bad < n").select("item", F.explode("tokens").alias("token"))
    baskets = materialise(pairs.join(mixed, "token").groupBy("url", "n", "n_bad").agg(F.array_sort(F.collect_set("item")).alias("items")), "baskets")
    bad = baskets.where("n_bad > 0").select("items", F.explode(F.sequence(F.lit(1), F.col("n_bad"))))
    rows = bad.count()
    found = sure
    if rows >= min_rows:
        sets = FPGrowth(itemsCol="items", minSupport=(min_rows - 0.5) / rows).fit(bad).freqItemsets
        sets = sets.where(F.size("items") <= max_tokens).select(F.array_sort("items").alias("antecedent"), "freq")
        sets = materialise(sets, "sets")
        # All rows with a set are looked up by its rarest item.
        rare = sets.select("antecedent", "freq", F.explode("antecedent").alias("item")).join(items.select("item", "n"), "item")
        rare = rare.groupBy("antecedent", "freq").agg(F.min(F.struct("n", "item"))["item"].alias("item"))
        held = baskets.select("items", "n", F.explode("items").alias("item")).join(rare, "item").where(F.size(F.array_except("antecedent", "items")) == 0)
        found = held.groupBy("antecedent", "freq").agg(F.sum("n").alias("n")).select("antecedent", "freq", "n").unionByName(sure)
    confidence = F.col("freq") / F.col("n")
    found = found.where(confidence >= least).select(
        F.array_join("antecedent", " ").alias("rule_id"), "antecedent", confidence.alias("confidence"), (confidence / base).alias("lift"), (F.col("freq") / total["n"]).alias("support")
    )
    found = materialise(found, "rules")
    general = found.select(F.col("antecedent").alias("_a"), F.col("confidence").alias("_c"), F.explode("antecedent").alias("_t"))
    narrow = found.select("rule_id", "antecedent", "confidence", F.explode("antecedent").alias("_t"))
    wider = (F.size("_a") < F.size("antecedent")) & (F.size(F.array_except("_a", "antecedent")) == 0) & (F.col("_c") >= F.col("confidence"))
    pruned = narrow.join(general, "_t").where(wider).select("rule_id").distinct()
    named = found.select("rule_id", F.explode("antecedent").alias("item")).join(items.select("item", "tokens"), "item")
    named = named.groupBy("rule_id").agg(F.collect_list(F.struct("item", "tokens")).alias("tokens"))  # at most max_tokens items
    return found.join(pruned, "rule_id", "left_anti").join(named, "rule_id").select("rule_id", "antecedent", "confidence", "lift", "support", "tokens")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct urls, of ``urls(url)``, that match a rule: url, n_rules, top_rule (the most confident, then the first by name)."""
    index = rules.select("rule_id", "confidence", F.size("tokens").alias("need"), F.explode("tokens").alias("t"))
    index = index.select("rule_id", "confidence", "need", "t.item", F.explode("t.tokens").alias("token"))
    hits = (
        urls.where("url is not null")
        .select("url")
        .distinct()
        .select("url", F.explode(tokens(F.col("url"))).alias("token"))
        .join(index, "token")
        .select("url", "rule_id", "need", "confidence", "item")
        .distinct()
        .groupBy("url", "rule_id", "need", "confidence")
        .agg(F.count("*").alias("have"))
        .where("have = need")
    )
    return hits.groupBy("url").agg(
        F.count("*").alias("n_rules"), F.min(F.struct((-F.col("confidence")).alias("c"), "rule_id"))["rule_id"].alias("top_rule")
    )


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, **mining) -> DataFrame:
    """One row per row of ``pages(page_id, url)``: page_id, host, path, rule, verdict, mined_rule.

    ``labels(page_id, bad)`` are the labels to mine. The longest explicit rule
    decides; without one, a url that matches a mined rule is blocked and any
    other is allowed. A null url has an empty host and path and is allowed.
    Repeated rows give repeated rows; an empty table gives an empty result;
    other columns are ignored.
    """
    pages = pages.select("page_id", "url")
    labelled = pages.join(labels.where("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad")), "page_id")
    mined = matched(pages, mine_rules(labelled, **mining))
    host, path = split_url(F.col("url"))
    rule, verdict = explicit_rule(F.col("host"), F.col("path"), rules)
    return (
        pages.join(mined, "url", "left")
        .select("page_id", host.alias("host"), path.alias("path"), "top_rule")
        .select(
            "page_id",
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("top_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"),
            F.col("top_rule").alias("mined_rule"),
        )
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document with its id; low quality or toxic is bad."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), labels)
