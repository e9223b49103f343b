"""Comparing all members of a group in pairs of bounded blocks, without pairs of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small

BLOCK = 1024


def blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each member once for every pair of blocks of its bucket that its block is in; blocks hold about BLOCK members."""
    cut = members.join(small(sizes), "key").withColumn("parts", F.ceil(F.col("size") / BLOCK).cast("int"))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return cut.select("*", other.alias("other")).withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")}).drop("other", "parts", "size")


def against_all(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Groups (key, lo, hi) in which each member with ``odd`` meets every member of its key once.

    sizes(key, size, odds). A key of at most BLOCK members is one group, its odd members on both sides (side 2). In a larger
    one, odd members are cut into blocks lo (side 0), all members into blocks hi (side 1), and each pair of blocks is a
    group; members that are not odd (side 1) meet only odd ones, so a key that is nearly one piece stays cheap at any size.
    """
    cut = members.join(small(sizes), "key").withColumns({"his": F.ceil(F.col("size") / BLOCK).cast("int"), "los": F.ceil(F.col("odds") / BLOCK).cast("int")})
    draw = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n).cast("long")).cast("int")
    kept = [c for c in members.columns if c != "odd"]
    whole = cut.where("his = 1").select(*kept, F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.when(F.col("odd"), 2).otherwise(1).alias("side"))
    all_ = cut.where("his > 1").select(*kept, F.explode(F.sequence(F.lit(0), F.col("los") - 1)).alias("lo"), draw("his", 5).alias("hi"), F.lit(1).alias("side"))
    odd = cut.where("his > 1 AND odd").select(*kept, draw("los", 11).alias("lo"), F.explode(F.sequence(F.lit(0), F.col("his") - 1)).alias("hi"), F.lit(0).alias("side"))
    return whole.unionByName(all_).unionByName(odd)


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each (key, lo, hi), from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        at = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("key", "lo", "hi")]
        n = batch.num_rows
        cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in at], axis=0)) + 1 if n > 1 else np.empty(0, np.int64)
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), n]):
            if a == b:
                continue
            name = tuple(x[a] for x in at)
            if now is not None and name != now:
                yield pa.Table.from_batches(held)
                held = []
            now = name
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
