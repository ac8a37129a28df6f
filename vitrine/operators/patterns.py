"""Patterns in listing terms and paths: frequent sets of terms with their rules, and frequent paths.

Frequent sets come from Spark's parallel FP-growth: items are dealt into groups, each group gets the conditional transactions of its items and grows its own trees,
so no task holds the whole tree. Frequent paths come from its PrefixSpan, which projects the sequences prefix by prefix. What is made of
them here (closed sets, rules with confidence and lift) are joins over the found sets.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.workspace import partitions_for, stage


def _share(least: int, n: int) -> float:
    """A share of n that stands for exactly `least` rows, whatever its rounding."""
    return min(1.0, max(0.0, (least - 0.5) / max(n, 1)))


# Rows that a task of the learners keeps in memory, as objects: a file of short rows holds many more than its bytes tell.
ROWS_PER_TASK = 50_000


def _spread(staged: DataFrame, rows: int) -> DataFrame:
    """The rows of a written table in partitions of about `ROWS_PER_TASK`. The learners of Spark cache the partitions they are given."""
    return staged.repartition(max(partitions_for(staged), rows // ROWS_PER_TASK + 1))


def frequent_sets(df: DataFrame, items: str, least: int) -> DataFrame:
    """(items, size, n): every set of items that at least `least` rows have, its items in order. Repeated items of a row count once; null items don't."""
    baskets = stage(df.select(F.array_sort(F.array_distinct(F.array_compact(F.col(items)))).alias("items")).where(F.size("items") > 0), "baskets")
    rows = baskets.count()
    if rows < least:
        return df.sparkSession.createDataFrame([], "items array<string>, size int, n long")
    grown = FPGrowth(itemsCol="items", minSupport=_share(least, rows), numPartitions=partitions_for(baskets)).fit(_spread(baskets, rows))
    found = grown.freqItemsets.select(F.array_sort("items").alias("items"), F.size("items").alias("size"), F.col("freq").alias("n"))
    return stage(found, "itemsets")


def _without_one(sets: DataFrame) -> DataFrame:
    """Every set of two items or more with each of its items taken out."""
    taken = sets.where("size > 1").select("items", "n", F.explode("items").alias("item"))
    return taken.select("items", "n", "item", F.array_remove("items", F.col("item")).alias("rest"))


def closed_sets(sets: DataFrame) -> DataFrame:
    """The sets that no larger set occurs as often as. Of a larger set that does, one with a single item more does, too."""
    covered = _without_one(sets).select(F.col("rest").alias("items"), "n").distinct()
    return sets.join(covered, ["items", "n"], "left_anti").select(sets.columns)


def rules(sets: DataFrame, rows: int, confidence: float) -> DataFrame:
    """(antecedent, consequent, n, confidence, lift) of all rules with one consequent and at least that confidence; `rows` is the number of baskets."""
    counts = sets.select("items", F.col("n").alias("_n"))
    split = _without_one(sets)
    named = split.join(counts.withColumnsRenamed({"items": "rest", "_n": "n_rest"}), "rest")
    single = counts.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), F.col("_n").alias("n_item"))
    found = named.join(single, "item").withColumn("confidence", F.col("n") / F.col("n_rest"))
    return found.where(F.col("n") >= confidence * F.col("n_rest")).select(
        F.col("rest").alias("antecedent"), F.col("item").alias("consequent"), "n", "confidence", (F.col("confidence") * rows / F.col("n_item")).alias("lift"))


def frequent_paths(df: DataFrame, path: str, least: int, longest: int = 5) -> DataFrame:
    """(path, length, n): sequences of up to `longest` segments that at least `least` rows have in this order, gaps allowed."""
    steps = df.select(F.transform(F.array_compact(F.col(path)), lambda s: F.array(s)).alias("sequence")).where(F.size("sequence") > 0)
    steps = stage(steps, "paths")
    rows = steps.count()
    if rows < least:
        return df.sparkSession.createDataFrame([], "path array<string>, length int, n long")
    span = PrefixSpan(minSupport=_share(least, rows), maxPatternLength=longest, sequenceCol="sequence")
    found = span.findFrequentSequentialPatterns(_spread(steps, rows)).select(F.flatten("sequence").alias("path"), F.col("freq").alias("n"))
    return found.select("path", F.size("path").alias("length"), "n")


def shown(items: Column) -> Column:
    return F.array_join(items, " ")
