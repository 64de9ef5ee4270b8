"""Mixing sources to target weights by entropy balancing.

Each source has a target of words. Document rates between 0 and ``most`` that meet the targets and stay closest, in
relative entropy to taking every document once, are exponential tilts: with x the document's size,
rate = most / (1 + (most - 1) * exp(-multiplier * x)). A multiplier above 0 repeats long documents,
one below 0 leaves them out first, and documents without words stay as they are. The convex dual has one
multiplier a source; its Newton iterations sum gradient and Hessian over groups of equal source and
size, which Spark counts once. An iterate that leaves the bracket known so far halves it.

Rates become whole copies by size: from long to short, each size takes the nearest number of copies and hands the words that are
too many or too few to the next, so that a source misses its target by no more than its short
documents allow. Documents of one size share the copies by the order of their hashes; where it
stops is found by counts over hash ranges, two digits deep. The number of jobs does not
depend on the data beyond the Newton iterations.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlife.cluster import attach, settle
from fleetlife.llm.store import stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
NEWTON_STEPS = 60
#: Relative error of a source's words at which its multiplier is settled, and decimals that are kept of it:
#: sums of doubles depend on their order in the last digits, reruns must not.
CLOSE, DECIMALS = 1e-9, 6
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a hash digit.
DIGIT = 12
#: The table of sizes is broadcast up to this many bytes of its files.
BROADCAST_BYTES = 8 << 20


def source_targets(sizes: DataFrame, weights=WEIGHTS, most=MOST_COPIES) -> DataFrame:
    """(source, source_size, target): shares of all words by weight, none above ``most`` times its size.

    ``sizes`` has (source, size, n). Resharing the excess until none is above ends where every open source has the same
    words a weight, so sources are closed in order of their bound a weight. Works on a
    row per source, in one task.
    """
    by_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (nth % len(weights) + 1).cast("int"))
    rows = by_source.withColumn("weight", weight).withColumn("bound", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum(F.col("source_size")).over(Window.partitionBy()).cast("double")
    level = (total - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("total", total).withColumn("level", level).withColumn("closed", F.col("bound") / F.col("weight") <= F.col("level"))
    # The first open source has the level that all open ones share.
    shared = F.first(F.when(~F.col("closed"), F.col("level")), ignorenulls=True).over(Window.partitionBy())
    return rows.select("source", "source_size", F.when(F.col("closed"), F.col("bound")).otherwise(F.col("weight") * shared).alias("target"))


def _key(source="source") -> Column:
    """A source as a join key; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def rate(most: int) -> Column:
    """The tilt of a document of size ``x`` (in mean sizes) by the multiplier ``m``."""
    return most / (1 + (most - 1) * F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("m") * F.col("x")))))


def balance(sizes: DataFrame, targets: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(of, source, source_size, target, mean, m) per source: the multipliers that meet the targets.

    ``sizes`` has (of, size, n). A source whose target is the whole of ``most`` times its size has no finite multiplier and
    gets one that no size tells from infinite; one without words keeps 0.
    """
    words = F.col("size").cast("double") * F.col("n")
    moments = sizes.groupBy("of").agg(F.round(F.try_divide(F.sum(words * F.col("size")), F.sum(words)), 3).alias("mean"))
    whole = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    state = targets.withColumn("of", _key()).join(moments, "of").withColumn("mean", F.coalesce("mean", F.lit(1.0)))
    state = settle(
        state.select(
            "of", "source", "source_size", "target", "mean",
            F.when((F.col("source_size") > 0) & whole, 1e18).otherwise(0.0).alias("m"),
            F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), ((F.col("source_size") == 0) | whole).alias("settled"),
        )
    )
    for _ in range(NEWTON_STEPS):
        if state.where("NOT settled").isEmpty():
            break
        rows = attach(sizes, state.where("NOT settled").select("of", "mean", "m"), "of").withColumn("x", F.col("size") / F.col("mean"))
        rows = rows.withColumn("r", rate(most)).withColumn("words", (F.col("size") * F.col("n")).cast("double"))
        sums = rows.groupBy("of").agg(F.sum(F.col("words") * F.col("r")).alias("words"), F.sum(F.col("words") * F.col("x") * F.col("r") * (1 - F.col("r") / most)).alias("slope"))
        error = F.col("words") - F.col("target")
        moved = state.join(sums, "of", "left").withColumn("low", F.when(error < 0, F.col("m")).otherwise(F.col("low"))).withColumn("high", F.when(error > 0, F.col("m")).otherwise(F.col("high")))
        newton = F.col("m") - F.try_divide(error, F.col("slope"))
        # A first step beyond what the other side has shown is held to twice the way so far.
        halved = F.when(F.col("low") == float("-inf"), F.col("high") * 2 - 1).when(F.col("high") == float("inf"), F.col("low") * 2 + 1).otherwise((F.col("low") + F.col("high")) / 2)
        inside = (newton > F.greatest("low", F.when(F.col("low") == float("-inf"), F.col("high") * 2 - 8).otherwise(F.col("low")))) & (
            newton < F.least("high", F.when(F.col("high") == float("inf"), F.col("low") * 2 + 8).otherwise(F.col("high")))
        )
        done = F.col("settled") | (F.abs(error) <= CLOSE * F.col("target")) | (F.col("high") - F.col("low") <= 1e-12 * F.abs("m"))
        state = settle(
            moved.select(
                "of", "source", "source_size", "target", "mean", F.when(done, F.col("m")).when(F.coalesce(inside, F.lit(False)), newton).otherwise(halved).alias("m"), "low", "high", done.alias("settled")
            )
        )
    return state.select("of", "source", "source_size", "target", "mean", F.when(F.col("m") < 1e17, F.round("m", DECIMALS)).otherwise(F.col("m")).alias("m"))


def rounded(size: np.ndarray, n: np.ndarray, rate: np.ndarray, target: float, most: int) -> np.ndarray:
    """Copies that all documents of each size take together, the words of all near ``target``.

    From long to short, what one size takes too much or too little is left to the next; what the
    bounds leave over is given to any size that it fits. Without words a document is taken once.
    """
    copies = n.copy()
    order = [i for i in np.argsort(-size, kind="stable").tolist() if size[i] > 0]
    left = 0.0
    for i in order:
        left += float(n[i]) * float(rate[i]) * float(size[i])
        copies[i] = min(max(int(np.floor(left / size[i] + 0.5)), 0), most * int(n[i]))
        left -= float(copies[i]) * float(size[i])
    left = target - float(sum(int(copies[i]) * int(size[i]) for i in order))
    for i in order:
        room = most * int(n[i]) - int(copies[i]) if left > 0 else int(copies[i])
        more = min(int(abs(left) // size[i]), room) * (1 if left > 0 else -1)
        copies[i] += more
        left -= more * float(size[i])
    # One copy more or less, where that comes nearer.
    sign = 1 if left > 0 else -1
    near = [i for i in order if abs(left - sign * float(size[i])) < abs(left) and (copies[i] < most * n[i] if left > 0 else copies[i] > 0)]
    if near:
        copies[min(near, key=lambda i: abs(left - sign * float(size[i])))] += sign
    return copies


def size_copies(sizes: DataFrame, state: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(of, size, n, rate, copies): copies of each source and size. A source has at most the square root of
    twice its words of different sizes, which one task rounds in order."""

    def share(pdf):
        pdf["copies"] = rounded(pdf["size"].to_numpy(), pdf["n"].to_numpy(), pdf["rate"].to_numpy(), float(pdf["target"].iloc[0]), most)
        return pdf[["of", "size", "n", "rate", "copies"]]

    rows = attach(sizes, state.select("of", "mean", "m", "target"), "of").withColumn("x", F.col("size") / F.col("mean"))
    rows = rows.select("of", "size", "n", rate(most).alias("rate"), "target")
    return rows.groupBy("of").applyInPandas(share, "of string, size long, n long, rate double, copies long")


def _crossing(counts: DataFrame, part: str) -> DataFrame:
    """Per source and size, the first ``part`` at which the running count passes ``left``, and what is left before it."""
    order = Window.partitionBy("of", "size").orderBy(part)
    ran = counts.withColumn("through", F.sum("c").over(order)).where("through > left")
    return ran.groupBy("of", "size").agg(F.min(part).alias("at"), F.min_by(F.col("left") - F.col("through") + F.col("c"), part).alias("left"))


def cuts(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """(of, size, cut): hashes below ``cut`` take a copy more than their size's whole number.

    A digit of the hash has 4,096 values, and two of them leave one part in 16 million of a
    size's documents; rows of one hash are taken together or not at all.
    """
    first, second = F.shiftright("u", 63 - DIGIT), F.shiftright("u", 63 - 2 * DIGIT)
    open_ = copies.select("of", "size", (F.col("copies") % F.col("n")).alias("left")).where("left > 0")
    found = attach(rows, open_, ["of", "size"], max_bytes=BROADCAST_BYTES).groupBy("of", "size", first.alias("p"), "left").agg(F.count("*").alias("c"))
    for digit, finer in ((first, second), (second, F.col("u"))):
        at = stored(_crossing(found, "p"))
        held = attach(rows, at, ["of", "size"], max_bytes=BROADCAST_BYTES).where(digit == F.col("at"))
        found = held.groupBy("of", "size", finer.alias("p"), "left").agg(F.count("*").alias("c"))
    return _crossing(found, "p").select("of", "size", F.col("at").alias("cut"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, carried=()) -> DataFrame:
    """Copies of each document so that sources get their target words.

    Takes doc_id, text and source of ``docs``; returns (doc_id, source, size, source_size,
    target, rate, copies, taken) and the ``carried`` columns for each row. size is the number of words, 0 for null
    text; a null source is a source of its own, the last. Documents without words are taken
    once. Rows with equal doc_id, source and size share their hash, so they
    are taken alike. An empty table gives an empty result.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", _key().alias("of"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.shiftrightunsigned(F.coalesce(F.xxhash64(F.col("doc_id").cast("string")), F.lit(0)), 1).alias("u"), *carried,
    )
    known = stored(rows.drop(*carried))
    sizes = stored(known.groupBy("of", "size").agg(F.first("source").alias("source"), F.count("*").alias("n")))
    state = balance(sizes, source_targets(sizes, weights, most), most)
    copies = stored(size_copies(sizes, state, most))
    whole = F.expr("copies div n").cast("int")
    table = copies.join(cuts(known, copies), ["of", "size"], "left").select("of", "size", "rate", whole.alias("whole"), "cut")
    table = stored(table.join(state.select("of", "source_size", "target"), "of"))
    taken = F.col("whole") + F.when(F.col("u") < F.col("cut"), 1).otherwise(0)
    found = attach(rows if carried else known, table, ["of", "size"], max_bytes=BROADCAST_BYTES).withColumn("copies", taken)
    return found.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"), *carried)
