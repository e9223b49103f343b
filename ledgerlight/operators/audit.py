"""Anomalies of raw delimited rows, by kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.normalize import filled, strip

WIDTH, SAMPLES = 13, 8
#: The fields by place, and the codes that are known.
FIELDS = ["district", "ac_code", "ac_name", "part_no", "serial_no", "local_ref", "first_name", "first_suffix", "relative_name", "relative_suffix", "relation_code", "age", "gender"]
KNOWN_RELATIONS, KNOWN_GENDERS = ["F", "H", "M", "O", ""], ["M", "F", "O", ""]


def anomalies(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """(file, line, cols, kinds) for rows(file, line, cols) of files named after their area; a row can have many kinds.

    meta(ac_code, ac_name, district): mismatches count only for files whose area is known.
    """
    area = F.regexp_extract("file", r"([^/]+?)\.[^./]+$", 1)
    known = meta.select(F.col("ac_code").alias("m_code"), F.col("ac_name").alias("m_name"), F.col("district").alias("m_district"))
    at = {f: strip(F.get("cols", i)) for i, f in enumerate(FIELDS)}
    size = F.size("cols")
    blank = (size == 0) | ((size == 1) & (strip(F.get("cols", 0)) == ""))
    tail = F.slice("cols", WIDTH + 1, F.greatest(size - WIDTH, F.lit(0)))
    full = F.exists(tail, lambda c: strip(c) != "")
    usual = F.when(F.upper(at["ac_code"]).startswith("A"), at["ac_code"]).otherwise(F.concat(F.lit("A"), filled(at["ac_code"], 3)))
    has_meta = F.col("m_code").isNotNull()
    differs = lambda field, expected: has_meta & (at[field] != "") & (F.lower(at[field]) != F.lower(F.trim(expected)))

    def number(field: str) -> list[Column]:
        empty = (at[field] == "") | (F.upper(at[field]) == "NULL")
        return [F.when(empty, f"empty_{field}"), F.when(~empty & ~at[field].rlike(r"^[+-]?\p{Nd}+(_\p{Nd}+)*$"), f"non_numeric_{field}")]

    whole = [
        F.when((size > WIDTH) & full, F.concat(F.lit("extra_nonempty_cols_"), size.cast("string"))),
        F.when((size > WIDTH) & ~full, F.concat(F.lit("extra_empty_cols_"), size.cast("string"))),
        F.when(has_meta & (usual != F.col("m_code")), "ac_code_mismatch"),
        F.when(differs("ac_name", F.col("m_name")), "ac_name_mismatch"),
        F.when(differs("district", F.col("m_district")), "district_mismatch"),
        F.when(at["first_name"] == "", "empty_first_name"),
        *number("part_no"), *number("serial_no"), *number("age"),
        F.when(~F.upper(at["relation_code"]).isin(KNOWN_RELATIONS), "unknown_relation_code"),
        F.when(~F.upper(at["gender"]).isin(KNOWN_GENDERS), "unknown_gender"),
        F.when(F.exists(F.slice("cols", 1, WIDTH), lambda c: F.contains(c, F.lit("�"))), "decode_replacement_char"),
    ]
    kinds = F.when(blank, F.array(F.lit("blank_line"))).when(size < WIDTH, F.array(F.concat(F.lit("too_few_cols_"), size.cast("string")))).otherwise(F.filter(F.array(*whole), lambda k: k.isNotNull()))
    joined = rows.withColumn("a__area", area).join(known, F.col("a__area") == F.col("m_code"), "left")
    return joined.select("file", "line", "cols", kinds.alias("kinds"))


def kind_counts(found: DataFrame, kinds: str = "kinds") -> DataFrame:
    """(kind, n), most frequent first, ties by name."""
    return found.select(F.explode(kinds).alias("kind")).groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind")


def samples(found: DataFrame, order: list[str], kept: list[str], most: int = SAMPLES) -> DataFrame:
    """The first rows of every kind in the given total order. A kind's rows are thinned in each task before they meet."""
    from pyspark.sql import Window

    rows = found.select(F.explode("kinds").alias("kind"), *order, *[c for c in kept if c not in order])
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy(*order))).where(F.col("place") <= most)


def value_counts(rows: DataFrame, file: str, columns: dict[str, Column]) -> DataFrame:
    """(file, column, value, n) for the given expressions."""
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("column"), value.cast("string").alias("value")) for name, value in columns.items()])).alias("p")
    return rows.select(F.col(file).alias("file"), pairs).groupBy("file", "p.column", "p.value").agg(F.count("*").alias("n"))


def many_valued(counts: DataFrame, column: str) -> DataFrame:
    """(file, values): histograms of the files with more than one value in the column."""
    one = counts.where(F.col("column") == column)
    return one.groupBy("file").agg(F.count("*").alias("values_n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("values")).where("values_n > 1").drop("values_n")


def odd_widths(counts: DataFrame, column: str = "width", expected: int = WIDTH) -> DataFrame:
    """Histograms of the files that have another width than the expected one."""
    one = counts.where(F.col("column") == column)
    odd = one.groupBy("file").agg(F.max(F.when(F.col("value") != str(expected), 1).otherwise(0)).alias("odd"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("values"))
    return odd.where("odd = 1").drop("odd")


def audit(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """One row: total_rows, files_seen, anomaly_counts and the files that stand out, ready for to_json."""
    found = anomalies(rows, meta)
    full = found.where(~F.array_contains("kinds", "blank_line"))
    deep = full.where(F.size("cols") >= WIDTH)
    columns = {f: strip(F.get("cols", FIELDS.index(f))) for f in ("ac_code", "district", "ac_name")}
    counts = value_counts(deep, "file", columns)
    widths = value_counts(full, "file", {"width": F.size("cols")})
    as_map = lambda df, k, v: df.agg(F.map_from_entries(F.collect_list(F.struct(k, v))))
    out = full.agg(F.count("*").alias("total_rows")).crossJoin(rows.agg(F.count_distinct("file").alias("files_seen")))
    out = out.crossJoin(as_map(kind_counts(found), "kind", "n").toDF("anomaly_counts"))
    for name, df in (("files_multi_ac_code", many_valued(counts, "ac_code")), ("files_multi_district", many_valued(counts, "district")), ("files_multi_ac_name", many_valued(counts, "ac_name")), ("files_nonstandard_colcount", odd_widths(widths))):
        out = out.crossJoin(as_map(df, "file", "values").toDF(name))
    return out
