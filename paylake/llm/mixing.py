"""Mixing sources to target weights by hash-threshold histograms.

Every document has a place on the hash line. For each source, sums of sizes over 1,024 stretches
of the line find the stretch in which the budget ends; only that stretch is cut into 1,024 finer
ones, and so on. The thresholds are nested, so raising a budget keeps every document taken before.
No document is sorted, and what is compared per source is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake.operators.scratch import stored

WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
MOST = 3  # times its size that a source is taken at most
BITS = 10  # of the hash line for each level of histograms
LEVELS = 3
SPACE = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), SPACE)
    edges = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (F.size(parts) - edges).cast("bigint")


def place(doc_id: Column) -> Column:
    """Place on the hash line: the first 30 bits of the id's md5."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), 2)


def _whole(name: str) -> Column:
    return F.col(name).cast("decimal(25,0)")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to one row per source with its ``source_size``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of all
    sizes. A source above ``most`` times its size keeps that much and the others share the rest by
    weight: those whose limit per weight is lowest are at their limit, and the first that is not
    shows the share of all others.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ratio = [F.col("source_size") * most / F.col("weight"), F.col("source").isNull(), F.encode("source", "utf-8")]
    before = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*ratio).rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))
    heavy = F.sum("weight").over(onward)
    ranked = weighed.withColumn("left", left).withColumn("heavy", heavy).withColumn("at", F.row_number().over(Window.orderBy(*ratio)))
    free = ranked.withColumn("free", _whole("left") * F.col("weight") <= _whole("source_size") * most * F.col("heavy"))
    first = free.withColumn("first", F.min(F.when(F.col("free"), F.struct("at", "left", "heavy"))).over(everything))
    shared = F.col("first.left") * F.col("weight") / F.col("first.heavy")
    limit = (F.col("source_size") * most).cast("double")
    return first.select("source", "source_size", F.when(F.col("at") >= F.col("first.at"), F.least(shared, limit)).otherwise(limit).alias("target"))


def budgets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source of rows with doc_id, source, size: source_size, target and how to reach it.

    A document is taken ``full`` times, and once more where its place is under ``below``.
    """
    rows = stored(sized.select("doc_id", "source", "size", place(F.col("doc_id")).alias("place")), "sized")
    top = BITS * LEVELS
    key = F.shiftright("place", top - BITS)
    histogram = stored(rows.groupBy("source", key.alias("bucket")).agg(F.sum("size").alias("sum")), "histogram")
    goal = targets(histogram.groupBy("source").agg(F.sum("sum").alias("source_size")), weights, most)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = stored(goal.withColumn("full", full.cast("bigint")).withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")), "goal")
    by_bucket = Window.partitionBy("source").orderBy("bucket")
    reached = goal.select("source", F.lit(0).cast("bigint").alias("below"), F.lit(0).cast("bigint").alias("taken"))
    for level in range(1, LEVELS + 1):
        if level > 1:  # only the stretch in which the budget ends
            inside = F.shiftright("place", top - BITS * (level - 1)) == F.shiftright("below", top - BITS * (level - 1))
            bucket = F.shiftright("place", top - BITS * level).alias("bucket")
            histogram = rows.join(reached, rows["source"].eqNullSafe(reached["source"]) & inside).groupBy(rows["source"], bucket).agg(F.sum("size").alias("sum"))
        known = goal.join(reached.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
            F.col("source").alias("s"), "rest", "taken", "below")
        up_to = histogram.join(known, F.col("source").eqNullSafe(F.col("s"))).withColumn(
            "until", F.col("taken") + F.sum("sum").over(by_bucket)).withColumn("next", F.shiftleft(F.col("bucket") + 1, top - BITS * level))
        fits = F.col("until") <= F.col("rest")
        # the whole buckets that fit move the threshold; the first that does not is where the budget ends
        found = up_to.groupBy("s").agg(
            F.max(F.when(fits, F.col("until"))).alias("sum_in"), F.min(F.when(~fits, F.struct("bucket", "until"))).alias("over"), F.max(F.when(fits, F.col("next"))).alias("next_in"),
            F.first("taken").alias("was"), F.first("below").alias("at"), F.first("rest").alias("rest"))
        taken = F.coalesce(F.col("sum_in"), F.col("was"))
        edge = F.shiftleft(F.col("over.bucket"), top - BITS * level)
        below = F.coalesce(edge, F.col("next_in"), F.col("at"))
        if level == LEVELS:  # the bucket of the budget's end goes in if that brings the sum nearer
            nearer = F.col("over").isNotNull() & (F.col("over.until") - F.col("rest") < F.col("rest") - taken)
            below = F.when(nearer, edge + F.lit(1 << (top - BITS * level))).otherwise(below)
        reached = stored(found.select(F.col("s").alias("source"), below.alias("below"), taken.alias("taken")), "threshold")
    edges = reached.select(F.col("source").alias("s"), "below")
    extra = F.when(F.col("rest") > 0, F.col("below")).otherwise(0)
    return goal.join(edges, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("budget_of"), "source_size", "target", "full", F.coalesce(extra, F.lit(0)).alias("below"))


def mix(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Adds source_size, target and ``times``, how often a document is taken, to rows with doc_id
    and source, by the budgets of their sources.

    A source is taken as often in full as its target allows; what is left of the target is taken
    from the documents below a threshold on the hash line, the one whose sum is nearest. Equal ids
    share a place and are taken alike; null is a source and an id like any other, and a source
    without words has target 0. An empty table gives an empty one.
    """
    extra = F.when(place(F.col("doc_id")) < F.col("below"), 1).otherwise(0)
    joined = documents.join(known, F.col("source").cast("string").eqNullSafe(F.col("budget_of")))
    return joined.withColumn("times", F.col("full") + extra).drop("budget_of", "full", "below")


def sizes(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"))


def mixture(documents: DataFrame) -> DataFrame:
    """Sizes, targets and words taken of all documents."""
    sized = stored(sizes(documents), "sizes")
    return mix(sized, budgets(sized)).select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))
