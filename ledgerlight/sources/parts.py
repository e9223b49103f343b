"""Part documents of an area: which ids to expect, and which areas can be read at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.normalize import filled


def padded(part: Column) -> Column:
    """Part id with its leading number zero-filled to four digits; a suffix stays."""
    number = F.regexp_extract(part, "^([0-9]+)", 1)
    return F.when(number == "", part).otherwise(F.concat(filled(number, 4), F.regexp_replace(part, "^[0-9]+", "")))


def listed(parts: Column) -> Column:
    """Trimmed ids that aren't blank, each once, in their order."""
    return F.array_distinct(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""))


def candidates(parts: Column) -> Column:
    """Padded ids to try: every number up to the largest listed one, and all listed ids, sorted. Lists have gaps."""
    ids = listed(parts)
    numbers = F.transform(F.filter(ids, lambda p: p.rlike("^[0-9]+$")), lambda p: p.cast("int"))
    top = F.coalesce(F.array_max(numbers), F.lit(0))
    every = F.when(top > 0, F.transform(F.sequence(F.lit(1), top), lambda n: filled(n.cast("string"), 4))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_union(every, F.transform(ids, padded)))


def readable(constituency: DataFrame, include_scanned: bool = False) -> DataFrame:
    """Areas whose rolls have a text layer, by extra['roll_format']; areas that don't say count as readable."""
    form = F.coalesce(F.try_element_at("extra", F.lit("roll_format")), F.lit("text"))
    return constituency if include_scanned else constituency.where(form != "scanned")


def guarded(rows: DataFrame, constituency: DataFrame, on_error: str = "fail") -> DataFrame:
    """rows(ac_code, …) of areas that can be read. A scanned area's rows stop the job, or are left out ("quarantine")."""
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error is 'fail' or 'quarantine'")
    scanned = constituency.where(F.try_element_at("extra", F.lit("roll_format")) == "scanned").select(F.col("ac_code").alias("g_code"))
    joined = rows.join(scanned, F.col("ac_code") == F.col("g_code"), "left")
    if on_error == "quarantine":
        return joined.where("g_code IS NULL").drop("g_code")
    message = F.concat(F.lit("scanned roll without text layer: "), F.col("ac_code"))
    return joined.where(F.when(F.col("g_code").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)).drop("g_code")
