"""Applying an expensive function once for every distinct value."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlight.functions import devanagari


def map_distinct(rows: DataFrame, columns: dict[str, str], function: Callable[[Column], Column], only: Callable[[Column], Column] | None = None, kind: str = "string") -> DataFrame:
    """rows with columns[source] = function(source), computed on distinct values that are not null (and satisfy ``only``).

    The map is joined back by Spark's own choice: broadcast when its size allows, by shuffle otherwise; skewed values are
    split by the adaptive join. A target that exists keeps its value where it has one.
    """
    values = None
    for source in columns:
        part = rows.select(F.col(source).alias("d__value")).where(F.col("d__value").isNotNull())
        values = part if values is None else values.union(part)
    if values is None:
        return rows
    if only is not None:
        values = values.where(only(F.col("d__value")))
    # the function costs far more than the values' bytes, by which small partitions would be put together
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    mapped = values.distinct().repartition(tasks).withColumn("d__new", function(F.col("d__value")))
    for i, (source, target) in enumerate(columns.items()):
        side = mapped.select(F.col("d__value").alias(f"d__v{i}"), F.col("d__new").alias(f"d__n{i}"))
        old = F.col(target) if target in rows.columns else F.lit(None).cast(kind)
        rows = rows.join(side, F.col(source) == F.col(f"d__v{i}"), "left").withColumn(target, F.coalesce(old, F.col(f"d__n{i}"))).drop(f"d__v{i}", f"d__n{i}")
    return rows


@F.pandas_udf(StringType())
def _romanized(values: pd.Series) -> pd.Series:
    return values.map(devanagari.romanize)


def latin_form(rows: DataFrame, column: str) -> Column:
    """The stored Latin form of a name, else one made while reading if the name is in Devanagari, else the name."""
    stored = F.col(f"{column}_latin")
    made = _romanized(F.when(stored.isNull() & devanagari.has_devanagari(F.col(column)), F.col(column)))
    return F.coalesce(stored, made, F.col(column))


def fill_latin(rows: DataFrame, states: list[str] | None = None) -> DataFrame:
    """Latin forms of both name columns where they are missing, for the given states (all if None).

    Names of other states keep their null; empty names have no form; filled values stay, so it can be run again.
    """
    wanted = F.lit(True) if states is None else F.col("state").isin(states)
    source = rows.withColumns({f"l__{c}": F.when(wanted & (F.col(c) != ""), F.col(c)) for c in ("full_name", "full_relative_name")})
    out = map_distinct(source, {f"l__{c}": f"{c}_latin" for c in ("full_name", "full_relative_name")}, _romanized)
    return out.drop("l__full_name", "l__full_relative_name")
