"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a folder of our own if everything runs in this process (tests),
    else an error: a folder of one machine would be written by every executor and found by none."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if known:
        return known.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("Set spark.checkpoint.dir to a folder that driver and executors share")
    made = getattr(spark, "_ledgerlight_shared", None)
    if made is None:
        folder = tempfile.mkdtemp(prefix="ledgerlight-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        made = spark._ledgerlight_shared = "file://" + folder
    return made


#: Hadoop starts a chmod process for each local file and checksum file, and until it runs, a process has its parent's memory
#: and counts as much again. Without the layer of checksums there is one less a file; Parquet has its own. Other stores than
#: file:// don't see this.
_LOCAL = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, has known statistics."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.options(**_LOCAL).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._ledgerlight_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what stored() wrote, once nothing reads it any more."""
    path = getattr(df, "_ledgerlight_path", None)
    if path:
        where = _hadoop_path(df.sparkSession, path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def stored_bytes(df: DataFrame) -> int | None:
    """Size of what stored() wrote; None for other tables."""
    path = getattr(df, "_ledgerlight_path", None)
    if path is None:
        return None
    where = _hadoop_path(df.sparkSession, path)
    return where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)
