"""Publishing rolls: versioned tables per area, resumable, with coverage and locality catalogues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight.schema import ROLL_COLUMNS

CONTRACT, PATCH = "c1", 0


def union_states(tables: dict[str, DataFrame], wanted: list[str]) -> DataFrame:
    """All rows of the wanted states; unknown states are an error that names the known ones."""
    missing = sorted(set(wanted) - set(tables))
    if missing:
        raise ValueError(f"Unknown states {missing}; known are {sorted(tables)}")
    return reduce(DataFrame.unionByName, [tables[s] for s in wanted])


def has_value(column: str) -> Column:
    return F.coalesce(F.col(column) != "", F.lit(False))


def area_index(rows: DataFrame, files: DataFrame, keys: list[str], locality: str = "locality") -> DataFrame:
    """(keys, row_count, has_locality 0/1) for every file, empty ones included."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("row_count"), F.max(has_value(locality).cast("int")).alias("has_locality"))
    return files.select(*keys).distinct().join(counts, keys, "left").select(*keys, F.coalesce("row_count", F.lit(0)).alias("row_count"), F.coalesce("has_locality", F.lit(0)).alias("has_locality"))


def coverage(index: DataFrame, state: str, totals: DataFrame) -> DataFrame:
    """(state, total, digitized, locality_coverage): none without files or localities, full if every file has some."""
    per = index.groupBy(state).agg(F.count("*").alias("digitized"), F.sum("has_locality").alias("with_locality"))
    out = totals.join(per, state, "left")
    level = F.when(F.coalesce("with_locality", F.lit(0)) == 0, "none").when(F.col("with_locality") == F.col("digitized"), "full").otherwise("partial")
    return out.select(state, "total", F.coalesce("digitized", F.lit(0)).alias("digitized"), level.alias("locality_coverage"))


def totals(index: DataFrame, state: str) -> DataFrame:
    """(state, areas, rows_n): areas with a file and their rows."""
    return index.groupBy(state).agg(F.count("*").alias("areas"), F.sum("row_count").alias("rows_n"))


def locality_catalog(rows: DataFrame, keys: list[str], locality: str = "locality") -> DataFrame:
    """Distinct non-empty localities per area; writing them again changes nothing."""
    return rows.where(has_value(locality)).select(*keys, locality).distinct()


def largest_groups(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Keys of the n largest groups, largest first, ties by key."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows_n")).orderBy(F.desc("rows_n"), *keys).limit(n)


def only_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(groups.select(*keys), keys, "left_semi")


def table_path(out: str, contract: str = CONTRACT, patch: int = PATCH) -> str:
    return f"{out}/rolls-{contract}.p{patch}"


def finished(spark: SparkSession, out: str, contract: str = CONTRACT, patch: int = PATCH) -> DataFrame | None:
    """(state, ac_code) of the areas that the manifest calls complete and whose data files hold as many readable rows as it
    says; None where there is no readable manifest. Files that can't be read count as missing, so their areas are built
    again. Only file footers are read for the counts."""
    from pyspark.errors import AnalysisException

    path, keys = table_path(out, contract, patch), ["state", "ac_code"]
    try:
        said = spark.read.parquet(f"{path}.manifest").groupBy(*keys).agg(F.max_by("row_count", "written").alias("row_count"))
    except AnalysisException:
        return None
    try:
        table = spark.read.option("ignoreCorruptFiles", True).schema("id long, state string, ac_code string").parquet(path)
    except AnalysisException:  # only empty areas so far
        return said.where("row_count = 0").select(*keys)
    found = table.groupBy(*keys).agg(F.count("*").alias("found"))
    return said.join(found, keys, "left").where(F.coalesce("found", F.lit(0)) == F.col("row_count")).select(*keys)


def publish(rows: DataFrame, files: DataFrame, out: str, contract: str = CONTRACT, patch: int = PATCH) -> DataFrame:
    """Write the areas of files(state, ac_code, file) that aren't complete yet; returns the areas that were written.

    Rows are clustered by area and sorted inside, so that file statistics prune by part and serial number. The manifest
    is appended to only after the data job has committed; a run that died is repeated from the same inputs, and changed
    inputs need a new patch number. Row ids start at 1 in each area. A large area is one sorted run of its own rows.
    """
    spark = rows.sparkSession
    done = finished(spark, out, contract, patch)
    keys = ["state", "ac_code"]
    todo = files.select(*keys).distinct() if done is None else files.select(*keys).distinct().join(done, keys, "left_anti")
    todo = spark.createDataFrame(todo.toArrow()) if todo.count() else todo.limit(0)  # area names only
    if todo.isEmpty():
        return todo
    place = Window.partitionBy(*keys).orderBy("file", "line")
    fresh = rows.join(todo, keys, "left_semi").withColumn("id", F.row_number().over(place).cast("long"))
    chosen = fresh.select(*[c for c in ROLL_COLUMNS if c in fresh.columns]).sortWithinPartitions(*keys, "part_no", "serial_no")
    path = table_path(out, contract, patch)
    chosen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    counts = spark.read.schema("id long, state string, ac_code string").parquet(path).join(todo, keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("row_count"))
    manifest = todo.join(counts, keys, "left").select(*keys, F.coalesce("row_count", F.lit(0)).alias("row_count"), F.current_timestamp().alias("written"))
    manifest.write.mode("append").parquet(f"{table_path(out, contract, patch)}.manifest")
    return todo


def state_coverage(index: DataFrame, constituency: DataFrame, labels: dict[str, str], built_at: Column | None = None) -> DataFrame:
    """(state_id, label, acs_total, acs_digitized, locality_coverage, built_at) per state of constituency(state, ac_code)."""
    totals = constituency.groupBy("state").agg(F.count("*").alias("total"))
    out = coverage(index, "state", totals)
    label = F.coalesce(*[F.when(F.col("state") == s, F.lit(x)) for s, x in labels.items()], F.col("state"))
    now = built_at if built_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return out.select(F.col("state").alias("state_id"), label.alias("label"), F.col("total").alias("acs_total"), F.col("digitized").alias("acs_digitized"), "locality_coverage", now.alias("built_at"))


def artefacts(spark: SparkSession, out: str, contract: str = CONTRACT, patch: int = PATCH) -> DataFrame:
    """(state, ac_code, contract, patch, file_size_bytes) of the published areas."""
    table = spark.read.parquet(table_path(out, contract, patch)).select("state", "ac_code", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n"))
    files = table.distinct()
    return files.groupBy("state", "ac_code").agg(F.sum("n").alias("file_size_bytes")).select("state", "ac_code", F.lit(contract).alias("contract"), F.lit(patch).alias("patch"), "file_size_bytes")


def migrate(spark: SparkSession, out: str, states: list[str], contract: str = CONTRACT, patch: int = PATCH) -> int:
    """Publish the next patch with the missing Latin names of the given states filled in; returns how many distinct names
    were missing, per column. It can be run again: filled names stay."""
    from .distinctmap import fill_latin

    old = spark.read.parquet(table_path(out, contract, patch))
    missing = sum(old.where(F.col("state").isin(states) & F.col(f"{c}_latin").isNull() & (F.col(c) != "")).select(c).distinct().count() for c in ("full_name", "full_relative_name"))
    fill_latin(old, states).select(*old.columns).write.mode("overwrite").partitionBy("state", "ac_code").parquet(table_path(out, contract, patch + 1))
    if finished(spark, out, contract, patch) is not None:
        spark.read.parquet(f"{table_path(out, contract, patch)}.manifest").write.mode("overwrite").parquet(f"{table_path(out, contract, patch + 1)}.manifest")
    return missing
