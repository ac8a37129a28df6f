"""Exact positions, ranks, samples and percentiles without putting a group into one task.

A window over a whole table, or over a group that holds a third of it, is one task.
Here the rows are range partitioned on (group, order) instead, so a large group is
spread over many partitions; the rows are numbered inside their partition, and the
number of rows in earlier partitions is added from a small table of partition counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.workspace import partitions_for, stage

ROW_BITS = (1 << 33) - 1


def _placed(df: DataFrame, keys: list[Column], parts: int | None) -> DataFrame:
    parts = parts or partitions_for(df)
    return stage(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)).alias("_row"),
        ),
        "placed",
    )


def with_position(
    df: DataFrame,
    order_by: Sequence[Column | str],
    within: Sequence[str] = (),
    name: str = "position",
    parts: int | None = None,
    running: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row by `order_by`, inside each `within` group if given.

    `order_by` must be unique inside a group: that makes the result the same on every
    run and lets any hot group be cut anywhere. `running` adds inclusive running sums
    over the same order, such as the successes so far.
    """
    running = running or {}
    keys = [F.col(c) for c in within] + [F.col(c) if isinstance(c, str) else c for c in order_by]
    columns = df.columns
    source = df.select("*", *[v.alias(f"_v_{k}") for k, v in running.items()])
    placed = _placed(source, keys, parts)
    blocks = placed.groupBy("_part", *within).agg(
        F.min("_row").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in running],
    )
    # One row per partition and group: at most the number of partitions for any one group.
    earlier = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        blocks.select(
            F.col("_part").alias("_bpart"),
            *[F.col(c).alias(f"_b_{c}") for c in within],
            "_first",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            *[F.coalesce(F.sum(f"_s_{k}").over(earlier), F.lit(0)).alias(f"_e_{k}") for k in running],
        ),
        "starts",
    )
    match = F.col("_part") == F.col("_bpart")
    for c in within:
        match = match & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    joined = placed.join(starts, match)
    # Bounded groups: one group inside one partition.
    so_far = Window.partitionBy("_part", *within).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *columns,
        (F.col("_before") + F.col("_row") - F.col("_first")).alias(name),
        *[(F.sum(f"_v_{k}").over(so_far) + F.col(f"_e_{k}")).alias(k) for k in running],
    )


def slice_rows(positioned: DataFrame, start: int, size: int, position: str = "position") -> DataFrame:
    """Rows [start, start + size) of a table that already carries positions."""
    return positioned.where((F.col(position) >= start) & (F.col(position) < start + size))


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int = 1) -> DataFrame:
    """The last n rows of each key. Spark cuts each task's rows to n per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def with_rank(counts: DataFrame, by: str, tie: str, name: str = "rank") -> DataFrame:
    """Competition rank of each row of an aggregate, largest `by` first."""
    placed = stage(with_position(counts, [F.col(by).desc(), F.col(tie)], name="_pos"), "ranked")
    # Most rows share a few counts; the staged side has one row for each count, so its size is known to the planner.
    first = stage(placed.groupBy(F.col(by).alias("_by")).agg((F.min("_pos") + 1).alias(name)), "first")
    return placed.join(first, F.col(by).eqNullSafe(F.col("_by"))).drop("_pos", "_by")


def sample_per_stratum(
    df: DataFrame, stratum: str, key: Column, fraction: float = 0.0, buckets_hex: int = 4, quotas: DataFrame | None = None
) -> DataFrame:
    """Exactly ceil(fraction * n) rows of each stratum, or as many as `quotas` (_of, _wanted) say, chosen by the md5 order of a unique key.

    A count per (stratum, hash prefix) shows in which prefix the quota of a stratum is
    reached. Rows below that prefix are all taken; rows at it are numbered, in groups of
    one prefix of one stratum (one in 16^buckets_hex of it). Rows above are not shuffled.
    """
    hashed = df.withColumn("_hash", F.md5(key)).withColumn("_prefix", F.substring("_hash", 1, buckets_hex))
    counts = hashed.groupBy(stratum, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    by_prefix = Window.partitionBy(stratum).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(stratum)
    wanted = F.ceil(F.sum("_n").over(total) * F.lit(fraction))
    if quotas is not None:
        counts = counts.join(quotas, F.col(stratum).eqNullSafe(F.col("_of"))).drop("_of")
        wanted = F.col("_wanted")
    quota = (
        counts.select(
            F.col(stratum).alias("_stratum"),
            F.col("_prefix").alias("_cut"),
            "_n",
            F.coalesce(F.sum("_n").over(by_prefix), F.lit(0)).alias("_below"),
            wanted.alias("_quota"),
        )
        .where((F.col("_below") < F.col("_quota")) & (F.col("_below") + F.col("_n") >= F.col("_quota")))
        .select("_stratum", "_cut", (F.col("_quota") - F.col("_below")).alias("_take"))
    )
    joined = hashed.join(stage(quota, "quota"), F.col(stratum).eqNullSafe(F.col("_stratum")))
    within_quota = joined.where(F.col("_prefix") <= F.col("_cut"))
    order = Window.partitionBy("_stratum", "_prefix").orderBy("_hash", key)
    taken = (F.col("_prefix") < F.col("_cut")) | (F.row_number().over(order) <= F.col("_take"))
    return within_quota.withColumn("_taken", taken).where("_taken").select(*df.columns)


def exact_percentile(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    fraction: float,
    name: str,
    accuracy: int = 20_000,
) -> DataFrame:
    """Exact percentile with linear interpolation, for groups of any size.

    The built-in exact percentile keeps every distinct value of a group in one task.
    Here a sketch of bounded size first brackets the wanted rank; the second pass counts
    what lies below the bracket and keeps only the distinct values inside it.
    """
    by = list(by)
    margin = 3.0 / accuracy
    lo, hi = max(0.0, fraction - margin), min(1.0, fraction + margin)
    present = df.where(F.col(value).isNotNull()).select(*by, value)
    sketch = F.percentile_approx(value, [lo, hi], accuracy)
    bounds = present.groupBy(*by).agg(
        sketch.alias("_b"), F.count(F.lit(1)).alias("_n"), F.min(value).alias("_min"), F.max(value).alias("_max")
    )
    # The sketch is off by at most n / accuracy ranks; groups too small for that margin are kept whole.
    small = F.col("_n") <= accuracy
    bounds = stage(
        bounds.select(
            *[F.col(c).alias(f"_k_{c}") for c in by],
            F.when(small, F.col("_min")).otherwise(F.col("_b")[0]).alias("_lo"),
            F.when(small, F.col("_max")).otherwise(F.col("_b")[1]).alias("_hi"),
            ((F.col("_n") - 1) * F.lit(fraction)).alias("_rank"),
        ),
        "bounds",
    )
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    if by:
        bracketed = present.join(bounds, match)
    else:
        one = bounds.first()
        bracketed = present.select(value, *[F.lit(one[c]).alias(c) for c in ("_lo", "_hi", "_rank")])
    # Values below the bracket collapse into one count per group before the shuffle.
    inside = F.col(value) >= F.col("_lo")
    counted = stage(
        bracketed.where(F.col(value) <= F.col("_hi"))
        .groupBy(*by, "_rank", F.when(inside, F.col(value)).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_c")),
        "counted",
    )
    ranked = with_position(counted, ["_value"], within=by, running={"_upto": F.col("_c")})
    ranked = ranked.where(F.col("_value").isNotNull())

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.col("_value")))

    low, high = at(F.floor("_rank")), at(F.ceil("_rank"))
    part = F.first("_rank") - F.floor(F.first("_rank"))
    return ranked.groupBy(*by).agg((low + (high - low) * part).alias(name))


def discrete_percentiles(counts: DataFrame, by: str, value: str, n: str, percents: dict[str, int]) -> DataFrame:
    """Exact percentiles, each a value that occurs, of distinct (by, value) rows that stand for `n` rows each; nulls don't count."""
    present = counts.where(F.col(value).isNotNull()).select(by, value, n)
    totals = stage(present.groupBy(F.col(by).alias("_by")).agg(F.sum(n).alias("_n")), "totals")
    ranked = with_position(present, [value], within=[by], running={"_upto": F.col(n)})
    ranked = ranked.join(totals, F.col(by).eqNullSafe(F.col("_by")))

    def at(percent: int) -> Column:
        rank = F.greatest(F.lit(1), F.col("_n") - F.floor(F.col("_n") * (100 - percent) / 100))
        return F.min(F.when(F.col("_upto") >= rank, F.col(value)))

    return ranked.groupBy(by).agg(*[at(p).alias(name) for name, p in percents.items()])


# Progress is reported at every hundredth item and at these counts.
PROGRESS_STEP = 100
MILESTONES = [500, 1000, 2500, 5000]


def milestone_stage(processed: Column) -> Column:
    return F.when(processed.isin(MILESTONES), F.lit("milestone")).when(
        processed % PROGRESS_STEP == 0, F.lit("progress")
    )


def milestones(rows: DataFrame, container: str, order_by: Sequence[str], ok: str) -> DataFrame:
    """The rows at which a container reaches a reported count, with the successes and failures so far."""
    counted = with_position(
        rows, order_by, within=[container], name="_before", running={"success": F.col(ok).cast("long")}
    )
    counted = counted.withColumn("processed", F.col("_before") + 1)
    counted = counted.withColumns(
        {"failed": F.col("processed") - F.col("success"), "stage": milestone_stage(F.col("processed"))}
    )
    return counted.where(F.col("stage").isNotNull()).drop("_before")
