"""Fuzzy search with filters, threshold and top k; verification of one record against a newer roll."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import scorers

from .distinctmap import latin_form, map_distinct

#: Most areas of one search; defaults of search and verification.
MAX_AREAS, MIN_SCORE, LIMIT, AGE_TOLERANCE = 5, 70.0, 20, 3
VERIFY_MIN_SCORE, VERIFY_LIMIT, VERIFY_TOLERANCE = 60.0, 10, 5

NO_ROLL = "no {year} roll is loaded for {area}"
NO_MATCH = "no record of {area} in {year} has this gender and an age of about {age}"


def one_of(column: Column, values: list | None, most: int | None = MAX_AREAS) -> Column:
    """Membership; no values, no filter. More than ``most`` values, repeated ones included, are an error."""
    if not values:
        return F.lit(True)
    if most is not None and len(values) > most:
        raise ValueError(f"At most {most} areas can be searched at once, not {len(values)}")
    return column.isin(list(values))


def about(column: Column, value: int | float | None, tolerance: int | float) -> Column:
    """Within the tolerance, ends included; unknown rows fail. No value, no filter."""
    return F.lit(True) if value is None else column.between(value - tolerance, value + tolerance)


def filtered(rows: DataFrame, ac_codes: list[str] | None = None, part_no: int | None = None, gender: str | None = None, age: int | None = None, age_tolerance: int = AGE_TOLERANCE) -> DataFrame:
    """Plain predicates only, so that they reach the scan. part 0 is a part; an empty gender is no filter."""
    wanted = one_of(F.col("ac_code"), ac_codes)
    if part_no is not None:
        wanted = wanted & (F.col("part_no") == part_no)
    if gender:
        wanted = wanted & (F.col("gender") == gender)
    return rows.where(wanted & about(F.col("age"), age, age_tolerance))


def pairs_filter(state: Column, area: Column, pairs: list[tuple[str, str]]) -> Column:
    """Any of the (state, area) pairs."""
    return reduce(lambda a, b: a | b, [(state == s) & (area == c) for s, c in pairs], F.lit(False))


def top_scored(rows: DataFrame, queries: list[str | None], columns: list[str | Column], key: str | list[str], algorithm: str = scorers.DEFAULT_ALGORITHM, min_score: float = MIN_SCORE, limit: int = LIMIT) -> DataFrame:
    """rows with score, best first, ties by key. The score is the mean over the fields that are asked for.

    Order, limit, threshold in this sequence gives the same rows as threshold first, since the threshold is on the leading
    sort key, and lets Spark keep only the best of every task; each row is scored once.
    """
    if not any(queries):
        raise ValueError("Give a name or a relative's name")
    fields = [F.col(c) if isinstance(c, str) else c for c in columns]
    keys = [key] if isinstance(key, str) else key
    scored = rows.withColumn("score", scorers.mean_score(queries, fields, algorithm))
    return scored.orderBy(F.desc("score"), *[F.asc(k) for k in keys]).limit(limit).where(F.col("score") >= min_score)


def score_once(rows: DataFrame, queries: list[str | None], columns: list[str], algorithm: str = scorers.DEFAULT_ALGORITHM) -> DataFrame:
    """rows with score, every distinct name scored once; for columns whose names repeat a lot.

    Scores don't depend on how rows are grouped, so areas need no batches of their own: a group's scores are its rows'.
    """
    asked = [(q, c) for q, c in zip(queries, columns) if q]
    total: Column = F.lit(None).cast("double")
    for i, (q, c) in enumerate(asked):
        rows = map_distinct(rows.withColumn(f"s__{i}", F.coalesce(c, F.lit(""))), {f"s__{i}": f"s__score{i}"}, lambda v, q=q: scorers.score(v, q, algorithm), kind="double")
        total = F.col(f"s__score{i}") if i == 0 else total + F.col(f"s__score{i}")
    out = rows.withColumn("score", total / len(asked) if asked else total)
    return out.drop(*[f"s__{i}" for i in range(len(asked))], *[f"s__score{i}" for i in range(len(asked))])


def score_by_group(rows: DataFrame, queries: list[str | None], columns: list[str], keys: list[str], algorithm: str = scorers.DEFAULT_ALGORITHM) -> DataFrame:
    """rows with score and spent_ms: one batch of names for each group of keys that a task meets, as in a flat scoring.

    Nothing is shuffled, so a large group is scored by all tasks that hold some of it. spent_ms is the time of a batch, on its
    first row; group_times() adds it up. The scores don't depend on the groups. A null name counts as empty; without a
    query there is no score.
    """
    asked = [(q, c) for q, c in zip(queries, columns) if q]
    many = scorers.batch(algorithm)
    schema = rows.schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, spent = np.full(batch.num_rows, np.nan), np.zeros(batch.num_rows)
            names = [np.array(batch.column(batch.schema.get_field_index(c)).fill_null("").to_pylist(), object) for _, c in asked]
            groups = pd.DataFrame({k: batch.column(batch.schema.get_field_index(k)).to_pandas() for k in keys}).groupby(keys, dropna=False, sort=False).indices if batch.num_rows else {}
            for at in groups.values():
                began = time.perf_counter()
                if asked:
                    score[at] = sum(many(q, own[at].tolist()) for (q, _), own in zip(asked, names)) / len(asked)
                spent[at[0]] = 1000 * (time.perf_counter() - began)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, mask=np.isnan(score)), pa.array(spent)], [*batch.schema.names, "score", "spent_ms"])

    return rows.mapInArrow(run, f"{schema}, score double, spent_ms double")


def group_times(scored: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows_n, spent_ms) of score_by_group()."""
    return scored.groupBy(*keys).agg(F.count("*").alias("rows_n"), F.sum("spent_ms").alias("spent_ms"))


def search(rows: DataFrame, name: str | None = None, relative: str | None = None, *, algorithm: str = scorers.DEFAULT_ALGORITHM, min_score: float = MIN_SCORE, limit: int = LIMIT, script_bridge: bool = True, **filters) -> DataFrame:
    """Best matches of a name and/or a relative's name among the rows that pass the filters.

    script_bridge: a query in Latin letters is held against the Latin form of a name, the stored one or, where none is
    stored, one that is made of a name in Devanagari while reading.
    """
    scorers.scalar(algorithm)
    fields = []
    for query, column in ((name, "full_name"), (relative, "full_relative_name")):
        latin = script_bridge and query and not any("ऀ" <= c <= "ॿ" for c in query) and f"{column}_latin" in rows.columns
        fields.append(latin_form(rows, column) if latin else F.col(column))
    return top_scored(filtered(rows, **filters), [name, relative], fields, "id", algorithm, min_score, limit)


def report(hits: DataFrame) -> DataFrame:
    """One printable line per hit."""
    line = F.format_string(
        "[%5.1f] %s (%s: %s) %s/%s #%s age %s %s",
        "score", "full_name", F.coalesce(F.nullif("relation_label", F.lit("")), F.lit("?")), "full_relative_name", "ac_code", F.col("part_no").cast("string"), F.col("serial_no").cast("string"), F.col("age").cast("string"), "gender",
    )
    return hits.select(line.alias("line"))


@dataclass(frozen=True)
class Record:
    """The one old record that is to be found again."""

    ac_code: str
    full_name: str
    full_relative_name: str = ""
    gender: str | None = ""
    age: int | None = None
    roll_year: int = 2002


def expected_age(record: Record, target_year: int) -> int:
    """Age by then; an unknown age counts as 0."""
    return (record.age or 0) + target_year - record.roll_year


def verify_record(rows: DataFrame, record: Record, target_year: int, algorithm: str = scorers.DEFAULT_ALGORITHM, min_score: float = VERIFY_MIN_SCORE, limit: int = VERIFY_LIMIT) -> tuple[DataFrame, str | None]:
    """(candidates, note) for exactly one record: same area and gender, the expected age, then the best names.

    The note says why there is nothing to compare: no such roll, or nobody of that gender and age. Candidates that all
    score too low give no rows and no note. A null gender matches nobody; an empty one matches an empty one.
    """
    age = expected_age(record, target_year)
    roll = rows.where((F.col("ac_code") == record.ac_code) & (F.col("roll_year") == target_year))
    same = roll.where((F.col("gender") == F.lit(record.gender).cast("string")) & about(F.col("age"), age, VERIFY_TOLERANCE))
    note = None
    if same.isEmpty():
        note = NO_ROLL.format(year=target_year, area=record.ac_code) if roll.isEmpty() else NO_MATCH.format(year=target_year, area=record.ac_code, age=age)
    return top_scored(same, [record.full_name, record.full_relative_name], ["full_name", "full_relative_name"], "id", algorithm, min_score, limit), note
