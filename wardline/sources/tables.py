"""Typed readers of the pipeline's CSV files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.clock import parse_time
from wardline.functions.items import VITALS

# Fixed pattern: the table is named after the file's stem.
TABLE_NAME = re.compile(r"(\w+)(\.csv)?$")

WIDE_COLUMNS = ("subject_id", "icustay_id", "charttime", *VITALS, "age")
STAY_COLUMNS = ("subject_id", "icustay_id", "intime", "outtime")
LABEL_COLUMNS = ("subject_id", "icustay_id", "charttime")
CHART_COLUMNS = ("subject_id", "charttime", "itemid", "avg_value")
GCS_COLUMNS = ("subject_id", "charttime", "gcs")


def table_name(path: str) -> str:
    found = TABLE_NAME.search(path)
    return found.group(1) if found else path


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, with the header's names."""
    return spark.read.csv(path, header=True, inferSchema=False)


def csv_as_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Read a CSV and register it as a temporary view."""
    df = read_text_csv(spark, path)
    df.createOrReplaceTempView(name or table_name(path))
    return df


def number(text: Column, kind: str = "double") -> Column:
    """Empty text becomes null."""
    return F.nullif(F.trim(text), F.lit("")).cast(kind)


def wide_rows(raw: DataFrame) -> DataFrame:
    """Typed wide hours; rows without a time are dropped."""
    return raw.select(
        number(F.col("subject_id"), "long").alias("subject_id"),
        number(F.col("icustay_id"), "long").alias("icustay_id"),
        parse_time(F.col("charttime")).alias("charttime"),
        *[number(F.col(v)).alias(v) for v in VITALS],
        number(F.col("age"), "int").alias("age"),
    ).where(F.col("charttime").isNotNull())


def stay_rows(raw: DataFrame, drop_blank_start: bool = False) -> DataFrame:
    """Typed stays; ``drop_blank_start`` leaves out stays without an admission time."""
    rows = raw.select(
        number(F.col("subject_id"), "long").alias("subject_id"),
        number(F.col("icustay_id"), "long").alias("icustay_id"),
        parse_time(F.col("intime")).alias("intime"),
        parse_time(F.col("outtime")).alias("outtime"),
    )
    return rows.where(F.col("intime").isNotNull()) if drop_blank_start else rows


def label_rows(raw: DataFrame) -> DataFrame:
    """Onset labels by position: subject, stay, time, whatever the header says."""
    subject, stay, time = (F.col(f"`{c}`") for c in raw.columns[:3])
    return raw.select(
        number(subject, "long").alias("subject_id"),
        number(stay, "long").alias("icustay_id"),
        parse_time(time).alias("charttime"),
    )


def chart_rows(raw: DataFrame) -> DataFrame:
    """Long item means, the same shape from either recording system."""
    return raw.select(
        number(F.col("subject_id"), "long").alias("subject_id"),
        parse_time(F.col("charttime")).alias("charttime"),
        number(F.col("itemid"), "long").alias("itemid"),
        number(F.col("avg_value")).alias("avg_value"),
    )


def gcs_rows(raw: DataFrame) -> DataFrame:
    return raw.select(
        number(F.col("subject_id"), "long").alias("subject_id"),
        parse_time(F.col("charttime")).alias("charttime"),
        number(F.col("gcs"), "int").alias("gcs"),
    )


def _header_csv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    return wide_rows(_header_csv(spark, path, WIDE_COLUMNS))


def read_stays(spark: SparkSession, path: str, drop_blank_start: bool = False) -> DataFrame:
    return stay_rows(_header_csv(spark, path, STAY_COLUMNS), drop_blank_start)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return label_rows(read_text_csv(spark, path))


def read_chart(spark: SparkSession, path: str) -> DataFrame:
    return chart_rows(_header_csv(spark, path, CHART_COLUMNS))


def read_gcs(spark: SparkSession, path: str) -> DataFrame:
    return gcs_rows(_header_csv(spark, path, GCS_COLUMNS))


def read_cohort(spark: SparkSession, path: str) -> DataFrame:
    """(subject_id): the distinct ids of the first column."""
    raw = read_text_csv(spark, path)
    return raw.select(F.trim(F.col(f"`{raw.columns[0]}`")).alias("subject_id")).dropDuplicates()
