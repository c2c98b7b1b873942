"""Gapless numbers inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number(rows: DataFrame, group: str, order: list[str], name: str, buckets: int, broadcast: bool = False) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    Rows are ordered inside buckets of their ``order`` columns' hash and shifted by the rows of
    the group's earlier buckets, so no task orders a whole group. Equal rows get different
    numbers, in any order. ``broadcast`` sends the groups x buckets offsets to all tasks: only
    for a bounded number of groups.
    """
    hashed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = hashed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    return (
        hashed.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets) if broadcast else offsets, [group, "_bucket"])
        .withColumn(name, F.col("_offset") + F.col("_row") - 1)
        .drop("_bucket", "_row", "_offset")
    )
