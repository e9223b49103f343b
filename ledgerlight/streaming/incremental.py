"""Resumable ingest of newly arrived files as a stream that stops when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.sources import files
from ledgerlight.sources.rolls import DelimitedSource


def ingest_new_files(spark: SparkSession, path: str, out: str, checkpoint: str, source: DelimitedSource, constituency: DataFrame, roll_year: int) -> None:
    """Append the records of files that the checkpoint hasn't seen, in one or more micro-batches, then stop.

    Each micro-batch is normalised by the same code as a batch read and overwritten as a whole if it is repeated, so a
    failed run adds no row twice.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    arrived = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.csv").load(path)
    named = arrived.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def write(batch: DataFrame, number: int) -> None:
        rows = source.normalized(files.delimited_rows(batch), constituency, roll_year).withColumn("batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    named.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
