"""Where a record's source document can be read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: States whose address follows from the area, and the code format of those with a table.
TEMPLATES = {"karnataka": "https://ceo.karnataka.gov.in/csv_upload/english/%s.csv"}
CODE_FORMATS = {"haryana": "HR%02d", "west_bengal": "AC%03d"}


def link_table(sheet: DataFrame, state: str) -> DataFrame:
    """(ac_code, part_no, url) of rows(row, cells) with a header: State, District, AC No, AC Name, Part No, PDF Link.

    Rows without a number or link are dropped; of equal keys the last wins; states without a table have no rows.
    """
    number = lambda i: F.get("cells", i).try_cast("double").cast("int")
    rows = sheet.where("row > 1").select("row", number(2).alias("ac_no"), number(4).alias("part_no"), F.get("cells", 5).alias("url"))
    rows = rows.where(F.col("ac_no").isNotNull() & F.col("part_no").isNotNull() & (F.coalesce("url", F.lit("")) != ""))
    if state not in CODE_FORMATS:
        rows = rows.limit(0)
    code = F.format_string(CODE_FORMATS.get(state, "%d"), "ac_no")
    return rows.groupBy(code.alias("ac_code"), "part_no").agg(F.max_by("url", "row").alias("url"))


def with_source_url(rows: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """rows with source_url: by template, by the table of links(state, ac_code, part_no, url), or ''."""
    template: Column = F.lit(None).cast("string")
    for state, form in TEMPLATES.items():
        template = F.when(F.col("state") == state, F.format_string(form, "ac_code")).otherwise(template)
    if links is None:
        return rows.withColumn("source_url", F.coalesce(template, F.lit("")))
    side = links.select(F.col("state").alias("u_state"), F.col("ac_code").alias("u_code"), F.col("part_no").alias("u_part"), F.col("url").alias("u_url"))
    joined = rows.join(side, (F.col("state") == F.col("u_state")) & (F.col("ac_code") == F.col("u_code")) & (F.col("part_no") == F.col("u_part")), "left")
    return joined.withColumn("source_url", F.coalesce(template, "u_url", F.lit(""))).drop("u_state", "u_code", "u_part", "u_url")
