"""Counts over dictionaries and code ranges, and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.session import shuffle_partitions


#: Groups that one task counts and labels.
GROUPS_OF_TASK = 500_000


def item_counts(events: DataFrame, d_items: DataFrame, *extra: str) -> DataFrame:
    """Rows per item (and ``extra`` columns) with the item's label.

    Events are counted per id before the label join, so the join moves one row per group. A label
    that the dictionary repeats counts as often. With ``extra`` columns there may be as many groups
    as events: their number, by an approximate count, then decides how many tasks share them.
    """
    keys = ["itemid", *extra]
    tasks = 0
    if extra:
        groups = events.agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
        tasks = -(-groups // GROUPS_OF_TASK)
    many = tasks > shuffle_partitions(events.sparkSession)
    if many:
        events = events.select(*keys).repartition(tasks, *keys)
    counts = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if many:
        counts = counts.repartition(tasks, "itemid")
    labels = d_items.groupBy("itemid", "label").agg(F.count(F.lit(1)).alias("_copies"))
    return counts.join(labels, "itemid").select(*keys, "label", (F.col("_n") * F.col("_copies")).alias("n"))


def value_counts(rows: DataFrame, column: str, contains: str | None = None) -> DataFrame:
    """Rows per value, optionally of the values that contain a text."""
    if contains is not None:
        rows = rows.where(F.col(column).like(f"%{contains}%"))
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def matching(rows: DataFrame, column: str, contains: str) -> DataFrame:
    return rows.where(F.col(column).like(f"%{contains}%"))


# Codes per block when ranges are matched; a range is repeated once per block it touches.
CODE_BLOCK = 1000


def code_range_counts(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows per subject, code and the section whose open range (low, high) holds the code.

    Events are first counted per (subject, code), so the range join sees each pair once; it
    is an equi-join on blocks of codes with the strict bounds as a filter.
    """
    counts = (
        events.groupBy("subject_id", "code")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_block", F.floor(F.col("code") / CODE_BLOCK))
    )
    blocks = ranges.where(F.col("low") < F.col("high")).withColumn(
        "_block",
        F.explode(F.sequence(F.floor(F.col("low") / CODE_BLOCK), F.floor(F.col("high") / CODE_BLOCK))),
    )
    return (
        counts.join(blocks, "_block")
        .where((F.col("code") < F.col("high")) & (F.col("code") > F.col("low")))
        .groupBy("subject_id", "code", "section")
        .agg(F.sum("_n").alias("n"))
    )


def subject_rows(rows: DataFrame, subject: int, order: Sequence[str]) -> DataFrame:
    return rows.where(F.col("subject_id") == subject).orderBy(*order)


def top_rows(rows: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows in a fixed order."""
    return rows.orderBy(*order).limit(n)
