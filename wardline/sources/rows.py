"""Typed CSV rows from lines, with the lines that hold no such row as a table of their own.

A bad line of a large file neither ends the job nor turns into silent nulls: each line leads to one
row or to one reject with its reason. Lines are parsed one by one, so files are split freely.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.items import VITALS

WIDE_ROW = "subject_id long, icustay_id long, charttime timestamp_ntz, " + "".join(f"{v} double, " for v in VITALS) + "age int"
STAY_ROW = "subject_id long, icustay_id long, intime timestamp_ntz, outtime timestamp_ntz"
LABEL_ROW = "subject_id long, icustay_id long, charttime timestamp_ntz"
CHART_ROW = "subject_id long, charttime timestamp_ntz, itemid long, avg_value double"
GCS_ROW = "subject_id long, charttime timestamp_ntz, gcs int"
COHORT_ROW = "subject_id long"

_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_bad",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def parse_rows(lines: DataFrame, schema: str, required: Sequence[str] = ()) -> Parsed:
    """Rows of ``schema`` from the column ``line``, and rejects (line, reason).

    A line is ``malformed`` with too few or too many fields, or with a field that is no value of
    its type; a blank field is null. ``missing NAME`` is a line whose required field NAME is blank,
    the first such in order. Blank and null lines are left out of both. Both tables read the lines again.
    """
    kept = lines.where(F.trim("line") != "").select("line")
    # the generator parses a line once, whatever the number of fields read from it
    parsed = kept.select("line", F.inline(F.array(F.from_csv("line", f"{schema}, _bad string", _OPTIONS))))
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    judged = parsed.withColumn("_reason", F.coalesce(F.when(F.col("_bad").isNotNull(), F.lit("malformed")), *missing))
    names = [c for c in parsed.columns if c not in ("line", "_bad")]
    return Parsed(
        judged.where(F.col("_reason").isNull()).select(*names),
        judged.where(F.col("_reason").isNotNull()).select("line", F.col("_reason").alias("reason")),
    )


def row_lines(df: DataFrame) -> DataFrame:
    """(line): each row as :func:`parse_rows` reads it; times are cut to the second."""
    return df.select(F.to_csv(F.struct(*df.columns), {"timestampNTZFormat": _OPTIONS["timestampNTZFormat"]}).alias("line"))


def read_rows(spark: SparkSession, path: str, schema: str, required: Sequence[str] = (), header: bool = True) -> Parsed:
    """:func:`parse_rows` over text files; a line that equals the header's names is left out of each file."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    if header:
        names = ",".join(part.split()[0] for part in schema.split(","))
        bare = F.regexp_replace(F.lower("line"), r'[\s"]', "")
        lines = lines.where(bare != names)
    return parse_rows(lines, schema, required)
