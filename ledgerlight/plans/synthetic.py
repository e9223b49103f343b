"""Invented rolls for measuring, from a formula: any size, the same on every run, made in the tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.operators import build

#: Rows per area and how often a name is a stub of one or two letters.
PER_AREA, STUB_EVERY = 40_000, 500

_FIRST = "Asha Bala Chandra Devi Esha Farid Gita Hari Indu Jaya Kiran Lata Mohan Nila Om Padma Ravi Sita Tara Uma".split()
_MIDDLE = "an esh ita kumar lal nath prasad raj veer wati".split()
_LAST = "Bhat Das Gowda Hegde Iyer Joshi Kulkarni Menon Naik Patil Rao Shetty Varma Yadav".split()


def _pick(words: list[str], seed: int) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(len(words))) + 1).cast("int"))


def rolls(spark: SparkSession, areas: int, seed: int = 42, per_area: int = PER_AREA) -> DataFrame:
    """(id, state, ac_code, full_name, full_relative_name) of areas * per_area rows."""
    name = F.concat(_pick(_FIRST, seed), _pick(_MIDDLE, seed + 1), F.lit(" "), _pick(_LAST, seed + 2), F.lit(" "), F.conv((F.pmod(F.xxhash64("id", F.lit(seed + 3)), F.lit(65)) + 10).cast("string"), 10, 26))
    stub = F.pmod(F.col("id"), F.lit(STUB_EVERY)) == 0
    return spark.range(areas * per_area).select(
        "id",
        F.lit("synthetic").alias("state"),
        F.concat(F.lit("AC"), F.floor(F.col("id") / per_area).cast("string")).alias("ac_code"),
        F.when(stub, F.substring(_pick(_FIRST, seed), 1, 2)).otherwise(name).alias("full_name"),
        F.concat(_pick(_FIRST, seed + 5), F.lit(" "), _pick(_LAST, seed + 2)).alias("full_relative_name"),
    )


def tier(spark: SparkSession, areas: int, table: DataFrame | None = None) -> DataFrame:
    """Rows of the largest ``areas`` areas of a stored roll, or invented ones where it is missing or has fewer areas."""
    if table is not None:
        groups = build.largest_groups(table, ["state", "ac_code"], areas)
        if groups.count() == areas:
            return build.only_groups(table, groups, ["state", "ac_code"]).select("id", "state", "ac_code", "full_name", "full_relative_name")
    return rolls(spark, areas)
