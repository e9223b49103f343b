"""Order-dependent operators: islands, anchored clusters, fills, as-of and range look-ups, gaps.

Two shapes: window functions over rows, for groups of any size, and array functions, for the few values of one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.storage import stored


def islands(rows: DataFrame, keys: list[str], value: str, gap: float, out: str = "island") -> DataFrame:
    """Chained clusters: a new one starts where a value exceeds the one before it by more than gap."""
    order = Window.partitionBy(*keys).orderBy(value)
    starts = F.when(F.col(value) - F.lag(value).over(order) > gap, 1).otherwise(0)
    return rows.withColumn("i__start", starts).withColumn(out, F.sum("i__start").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("i__start")


def anchored(values: Column, reach: float) -> Column:
    """Clusters of a sorted array<double>: a value joins while it is within reach of the cluster's first; array of arrays."""
    return F.aggregate(
        values,
        F.array().cast("array<array<double>>"),
        lambda done, v: F.when(
            (F.size(done) > 0) & (v - F.get(F.get(done, F.size(done) - 1), 0) <= reach),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.concat(F.get(done, F.size(done) - 1), F.array(v)))),
        ).otherwise(F.concat(done, F.array(F.array(v)))),
    )


def chained(values: Column, gap: float) -> Column:
    """Means of the chained clusters of an array<double>."""
    ordered = F.array_sort(values)
    groups = F.aggregate(
        ordered,
        F.array().cast("array<array<double>>"),
        lambda done, v: F.when(
            (F.size(done) > 0) & (v - F.element_at(F.get(done, F.size(done) - 1), -1) <= gap),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.concat(F.get(done, F.size(done) - 1), F.array(v)))),
        ).otherwise(F.concat(done, F.array(F.array(v)))),
    )
    return F.transform(groups, lambda g: F.aggregate(g, F.lit(0.0), lambda a, x: a + x) / F.size(g))


def fill_forward(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The last known value up to each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(value, ignorenulls=True).over(w))


def first_known(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The group's first known value, on all its rows; by partial aggregation, so a large group is no single task."""
    first = rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(F.struct(*order, F.col(value).alias("f__v")))["f__v"].alias(out))
    return rows.join(first, keys, "left")


def ordinal(rows: DataFrame, order: list[str], out: str = "id") -> DataFrame:
    """1, 2, 3, … in the given total order, without one task that holds all rows.

    Rows are range-partitioned and sorted by the order and written once, with their partition and their place in it; a
    row's number is its place after the rows of the partitions before. Counting and numbering read the same files, since
    a range partitioning that is planned twice may be cut and coalesced in two ways. One shuffle; the written rows stay
    in the shared folder (storage.discard() deletes them). An empty table gives no rows.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    held = stored(spread.select("*", F.spark_partition_id().alias("o__pid"), place.alias("o__at")), "ordinal")
    counts = held.groupBy("o__pid").agg(F.count("*").alias("o__n"))
    before = Window.orderBy("o__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    base = counts.select(F.col("o__pid").alias("o__p"), F.coalesce(F.sum("o__n").over(before), F.lit(0)).alias("o__base"))
    numbered = held.join(base, F.col("o__pid") == F.col("o__p")).withColumn(out, F.col("o__base") + F.col("o__at") + 1)
    numbered = numbered.drop("o__pid", "o__at", "o__p", "o__base")
    numbered._ledgerlight_path = held._ledgerlight_path
    return numbered


def surrounding(rules: Column, at: Column) -> Column:
    """As-of both ways: struct(lo, hi) with the greatest rule <= at and the least rule > at; null where a side is missing."""
    lo, hi = F.array_max(F.filter(rules, lambda r: r <= at)), F.array_min(F.filter(rules, lambda r: r > at))
    return F.when(lo.isNotNull() & hi.isNotNull(), F.struct(lo.alias("lo"), hi.alias("hi")))


def asof_latest(left: DataFrame, right: DataFrame, key: str, time: str, value: str, out: str) -> DataFrame:
    """For each left row the value of the latest right row of its key at or before its time.

    Both sides go through one window over (key, time), linear in their rows; right rows come first at equal times.
    """
    one = left.withColumns({"a__side": F.lit(1), "a__v": F.lit(None).cast(right.schema[value].dataType)})
    two = right.select(*[F.col(c) if c in (key, time) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns], F.lit(0).alias("a__side"), F.col(value).alias("a__v"))
    w = Window.partitionBy(key).orderBy(time, "a__side").rowsBetween(Window.unboundedPreceding, 0)
    return one.unionByName(two).withColumn(out, F.last("a__v", ignorenulls=True).over(w)).where("a__side = 1").drop("a__side", "a__v")


def bucket(value: Column, bounds: list[float]) -> Column:
    """Number of bounds <= value: column i of half-open ranges [bound i-1, bound i)."""
    return sum((F.when(value >= b, 1).otherwise(0) for b in bounds), F.lit(0)).cast("int")


def first_range(value: Column, ranges: Column) -> Column:
    """Index of the first struct(lo, hi) with lo <= value < hi; null if none. Ranges may overlap."""
    hit = F.transform(ranges, lambda r, i: F.when((r["lo"] <= value) & (value < r["hi"]), i))
    return F.get(F.filter(hit, lambda i: i.isNotNull()), 0)


def upper_median(values: Column) -> Column:
    """Element at place n // 2 of the sorted array, 0.0 if it is empty."""
    return F.when(F.size(values) > 0, F.get(F.sort_array(values), F.floor(F.size(values) / 2).cast("int"))).otherwise(0.0)


def occupancy(rows: DataFrame, keys: list[str], lo: str, hi: str, first: int, last: int) -> DataFrame:
    """(keys, x, n): how many integer ranges [lo, hi] cover each x of [first, last]; uncovered ones have 0."""
    span = F.sequence(F.greatest(F.col(lo), F.lit(first)), F.least(F.col(hi), F.lit(last)))
    covered = rows.where((F.col(lo) <= last) & (F.col(hi) >= first)).select(*keys, F.explode(span).alias("x")).groupBy(*keys, "x").agg(F.count("*").alias("n"))
    every = rows.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(first), F.lit(last))).alias("x"))
    return every.join(covered, [*keys, "x"], "left").select(*keys, "x", F.coalesce("n", F.lit(0)).alias("n"))


def widest_gap(profile: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, centre): middle of the widest run of uncovered x with covered ones on both sides, the first of equals; the
    first least covered x where there is none. profile: rows of occupancy()."""
    w = Window.partitionBy(*keys).orderBy("x")
    runs = profile.withColumn("r__ink", F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    total = profile.groupBy(*keys).agg(F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("r__all"), F.min(F.struct("n", "x"))["x"].alias("r__least"))
    blank = runs.where("n = 0").groupBy(*keys, "r__ink").agg(F.min("x").alias("a"), (F.max("x") + 1).alias("b"))
    inner = blank.join(total, keys).where("r__ink > 0 AND r__ink < r__all")
    best = inner.groupBy(*keys).agg(F.min(F.struct((F.col("a") - F.col("b")).alias("size"), "a", "b")).alias("r__best"))
    return total.join(best, keys, "left").select(*keys, F.coalesce((F.col("r__best.a") + F.col("r__best.b") - 1) / 2, F.col("r__least").cast("double")).alias("centre"))
