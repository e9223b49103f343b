"""A training corpus from documents: quality rules, language, near-duplicates, mixture, packed windows.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.llm.common import discard, materialize, scratch, table
from ledgerlight.llm.langid import keep_languages
from ledgerlight.llm.mixing import mix
from ledgerlight.llm.neardup import drop_near_duplicates
from ledgerlight.llm.packing import pack
from ledgerlight.llm.quality import keep_good
from ledgerlight.llm.tokens import default_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or their group's adaptive fences.

    Null and empty texts fail; very long ones are judged whole; null lang or source is a group of its own; values equal to
    a fence pass; repeated rows are judged row by row; an empty table gives no rows; columns keep their names, also those
    that the operator uses.
    """
    return keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or in no learned language.

    Null and empty texts go; very long ones are counted whole, in pieces; a tie between languages doesn't matter, as the
    document stays; null lang or doc_id teaches nothing; repeated rows are judged row by row; an empty table gives no rows;
    columns keep their names.
    """
    return keep_languages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component: five-word shingles, similarity 0.8.

    Null, empty and wordless texts are near nothing; whole texts are compared, however long; the smallest doc_id stays, null
    ones last; rows that are equal in doc_id and text are one; different texts under one doc_id are documents of their
    own; an empty table gives no rows; columns keep their names.
    """
    return drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats smaller sources up to twice, towards the flattest mixture of tokens; every document stays at least once.

    Null and empty texts cost nothing; long texts count whole; null source is a source; equal rows are dealt alike; an empty
    table gives no rows; columns keep their names, only mix_* are replaced and left out.
    """
    return mix(docs, tokenizer=default_path()).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens, each with the sources' shares; a row per piece.

    Null and empty texts give the end id alone; long texts are cut into many windows; null source is a queue of its own;
    equal and repeated rows are packed row by row; an empty table gives no rows; other columns are left out.
    """
    return pack(docs, digest=True)


STAGES = [("quality", quality_rules), ("language", language_id), ("near_duplicates", near_duplicates), ("mixing", mixture), ("packing", packing)]

#: SQL has neither the sketches, the tokenizer nor the mixture; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's table is deleted once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch() as keep:
            done = keep(materialize(stage(spark, docs, sf_dir), f"stage-{name}"))
        discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
