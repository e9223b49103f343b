"""The normalised roll record. Missing text is '', missing numbers are null, Latin forms are null until filled."""

from __future__ import annotations

from pyspark.sql import types as T

_INTS = {"roll_year", "part_no", "serial_no", "age"}
#: The record's columns in order.
ROLL_COLUMNS = ["id", "state", "roll_year", "district", "ac_code", "ac_name", "part_no", "serial_no", "local_ref", "full_name", "full_name_latin", "full_relative_name", "full_relative_name_latin", "relation_code", "relation_label", "age", "gender", "remark", "locality", "source_url"]

ROLL_SCHEMA = T.StructType([T.StructField(c, T.LongType() if c == "id" else T.IntegerType() if c in _INTS else T.StringType()) for c in ROLL_COLUMNS])

CONSTITUENCY_SCHEMA = T.StructType(
    [T.StructField("ac_code", T.StringType()), T.StructField("ac_name", T.StringType()), T.StructField("district", T.StringType()), T.StructField("total_parts", T.IntegerType()), T.StructField("extra", T.MapType(T.StringType(), T.StringType()))]
)
