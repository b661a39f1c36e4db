"""Mixing sources to target weights by entropy balancing.

Native DataFrame operations only. Each document gets a rate, the number of
times that the mix takes it. Of all rates that meet a source's token
constraint and stay below the cap, entropy balancing takes those closest to one
in relative entropy, where a document of size t weighs t + m (m is the mean size
of its source). They are exponentially tilted: min(cap, exp(lambda * x)) with
x = t / (t + m). The convex dual in lambda is solved by Newton iterations for
all sources at once over a histogram of sizes, with a bracket that falls back to
bisection. Rounding to whole copies carries the words left over from the longest
documents of a source to the shortest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, ranked, table, word_count

MAX_STEPS = 60
TOLERANCE = 1e-7
BUCKET_ROWS = 4096
RANGE_SIZES = 256


def cyclic_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``sources(source, ...)`` with weight: the given weights over the sources by code point, null last, repeating."""
    placed = ranked(sources, "source", "_rank")
    rank = F.col("_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    return placed.withColumn("weight", weight).drop("_rank")


def share_targets(sources: DataFrame, total_share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sources(source, source_size, weight)`` with target.

    Shares total_share times all sizes by weight. A target stops at cap times
    its source's size; the excess is shared again until no target is above.
    """
    limit = cap * F.col("source_size")
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    level, pinned = None, -1
    while True:  # each round pins at least one more source
        over = F.lit(False) if level is None else limit <= level * F.col("weight")
        r = sources.agg(
            F.sum(F.when(over, limit)).alias("fixed"), F.sum(F.when(~over, F.col("weight"))).alias("open"), F.count(F.when(over, 1)).alias("n")
        ).first()
        if r["n"] == pinned or not r["open"]:
            break
        pinned, level = r["n"], (total_share * whole - (r["fixed"] or 0)) / r["open"]
    target = F.lit(0.0) if level is None else F.least(limit, level * F.col("weight"))
    return sources.withColumn("target", limit if level is not None and not r["open"] else target)


def _tilt(lam: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(lam * F.col("x"), F.lit(50.0))))


def balance(groups: DataFrame, sources: DataFrame, cap: float = 2.0, tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS) -> DataFrame:
    """Solves the dual: ``sources`` with lam.

    ``groups(source, size, n)`` counts documents by size. The constraint's
    error, sum n t min(cap, e^(lam x)) - target, rises with lam; its root is
    bracketed from the start, and a Newton step outside the bracket is replaced
    by bisection. Only the number of unsolved sources reaches the driver.
    """
    x = F.col("size") / (F.col("size") + F.col("mean"))
    least = 1.0 / (1.0 + F.col("mean"))
    state = materialise(
        sources.withColumns(
            {
                "lam": F.lit(0.0),
                "lo": F.when((F.col("target") > 0) & (F.col("source_size") > 0), F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))) / least).otherwise(-1.0),
                "hi": F.log(F.lit(float(cap))) / least,
                "solved": F.col("source_size") == 0,
            }
        ),
        "dual",
    )
    full = F.col("target") >= cap * F.col("source_size")
    for _ in range(max_steps):
        open_ = state.where(~F.col("solved"))
        seen = groups.join(open_.select(F.col("source").alias("_s"), "lam", "mean"), F.col("source").eqNullSafe(F.col("_s"))).withColumn("x", x)
        mass = F.col("n") * F.col("size") * _tilt(F.col("lam"), cap)
        slope = F.when(F.col("lam") * F.col("x") < F.log(F.lit(float(cap))), mass * F.col("x")).otherwise(0.0)
        sums = seen.groupBy("_s").agg(F.sum(mass).alias("mass"), F.sum(slope).alias("slope"), F.lit(True).alias("hit"))
        error = F.col("mass") - F.col("target")
        lo, hi = F.when(error < 0, F.col("lam")).otherwise(F.col("lo")), F.when(error > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.try_divide(error, F.col("slope"))
        inside = F.coalesce((newton > lo) & (newton < hi), F.lit(False))
        done = F.col("solved") | full | (F.abs(error) <= tolerance * F.col("target")) | (hi - lo <= 1e-13 * F.greatest(F.abs(lo), F.abs(hi)))
        moved = F.when(F.col("solved"), F.col("lam")).when(full, F.col("hi")).when(done, F.col("lam")).when(inside, newton).otherwise((lo + hi) / 2)
        kept = [c for c in state.columns if c not in ("lam", "lo", "hi", "solved")]
        state = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            *kept,
            moved.alias("lam"),
            F.coalesce(lo, F.col("lo")).alias("lo"),
            F.coalesce(hi, F.col("hi")).alias("hi"),
            F.coalesce(done, F.lit(True)).alias("solved"),
        )
        state = materialise(state, "dual")
        if state.where(~F.col("solved")).isEmpty():
            break
    return state.drop("lo", "hi", "solved")


def whole_copies(groups: DataFrame, cap: float = 2.0) -> DataFrame:
    """``groups(source, size, n, rate, ...)`` with group_copies, the copies that all documents of a size get together.

    Goes from the longest size of a source to the shortest and carries the
    words that rounding left over into the next size, so the last remainder is
    about a word. Sizes are dealt in ranges of ``RANGE_SIZES``, each of which
    starts without a carry; what a range leaves over is then carried from range
    to range and settled by the shortest size of each.
    """
    keys = groups.select("source", "size", "n", "rate")
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("size"))) - 1
    ranges = keys.withColumn("range", F.floor(place / RANGE_SIZES)).groupBy("source", "range")
    ranges = ranges.agg(F.sort_array(F.collect_list(F.struct("size", "n", "rate")), asc=False).alias("sizes"))

    def most(g: Column) -> Column:
        return F.floor(g["n"] * F.lit(float(cap)))

    def step(acc: Column, g: Column) -> Column:
        ideal = g["n"] * g["rate"] + F.try_divide(acc["carry"], g["size"])
        taken = F.coalesce(F.greatest(F.lit(0), F.least(most(g), F.round(ideal).cast("long"))), g["n"])
        return F.struct(
            F.coalesce((ideal - taken) * g["size"], acc["carry"]).alias("carry"),
            F.concat(acc["copies"], F.array(taken)).alias("copies"),
        )

    def settle(acc: Column, r: Column) -> Column:
        carry = acc["carry"] + r["carry"]
        moved = F.greatest(-r["taken"], F.least(most(r) - r["taken"], F.round(F.try_divide(carry, r["size"])).cast("long")))
        moved = F.coalesce(moved, F.lit(0).cast("long"))
        return F.struct((carry - moved * r["size"]).alias("carry"), F.concat(acc["copies"], F.array(moved)).alias("copies"))

    start = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<bigint>").alias("copies"))
    folded = materialise(ranges.withColumn("f", F.aggregate("sizes", start, step)).select("source", "range", "sizes", "f.*"), "folded")
    end = F.element_at("sizes", -1)
    summary = F.struct("range", end["size"].alias("size"), end["n"].alias("n"), F.element_at("copies", -1).alias("taken"), "carry")
    settled = folded.groupBy("source").agg(F.sort_array(F.collect_list(summary)).alias("ranges"))  # a row for each range
    moved = F.explode(F.arrays_zip("ranges", F.aggregate("ranges", start, settle, lambda x: x["copies"]).alias("moved")))
    settled = settled.select(F.col("source").alias("_s"), moved.alias("m")).select("_s", F.col("m.ranges.range").alias("_r"), "m.moved")
    both = folded.join(settled, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
    copies = F.concat(F.slice("copies", F.lit(1), F.size("copies") - 1), F.array(F.element_at("copies", -1) + F.col("moved")))
    both = both.select("source", F.explode(F.arrays_zip("sizes", copies.alias("copies"))).alias("g"))
    both = both.select(F.col("source").alias("_s"), F.col("g.sizes.size").alias("_z"), F.col("g.copies").alias("group_copies"))
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))
    return groups.join(both, same).drop("_s", "_z")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), total_share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: doc_id, source, size, source_size, target, rate, copies, taken.

    size counts words; a null or empty text has none and is taken once, adding
    nothing. A null source is a source of its own. A source's words miss its
    target by no more than a short document, and by one in ``BUCKET_ROWS`` where
    very many documents share a size. Reruns give the same copies; rows that share a
    doc_id are told apart only by their order. An empty table gives an empty
    result; other columns are ignored.
    """
    words = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    groups = materialise(words.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    sources = groups.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"), (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean")
    )
    sources = share_targets(cyclic_weights(sources, weights), total_share, cap)
    solved = balance(groups.where("size > 0"), sources, cap)
    solved = solved.withColumnRenamed("source", "_s")
    x = F.when(F.col("size") > 0, F.col("size") / (F.col("size") + F.col("mean"))).otherwise(0.0)
    rated = (
        groups.join(solved, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("x", x)
        .withColumn("rate", _tilt(F.col("lam"), cap))
        .select("source", "size", "n", "rate", "source_size", "target")
    )
    rated = materialise(whole_copies(rated, cap).withColumnsRenamed({"source": "_s", "size": "_z"}), "rates")
    bucket = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / BUCKET_ROWS))
    placed = (
        words.join(rated, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")))
        .withColumn("bucket", bucket)
        .withColumn("at", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("doc_id")))
        .withColumn("start", F.when(F.col("n") > BUCKET_ROWS, F.pmod(F.xxhash64("size", "bucket"), F.col("n"))).otherwise(0))
    )
    copies = F.expr("(start + at * group_copies) div n - (start + (at - 1) * group_copies) div n")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "rate", copies.cast("int").alias("copies"), (copies * F.col("size")).cast("long").alias("taken")
    )


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")
