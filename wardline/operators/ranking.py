"""Row numbers inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_index(
    rows: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], name: str = "idx"
) -> DataFrame:
    """Zero-based position of each row in its group, ordered by (bucket, order).

    Rows are numbered inside (keys, bucket) and shifted by the size of the earlier buckets,
    so no task ever sorts a whole group: the group-wide window runs over bucket counts only.
    ``bucket`` must not decrease along the wanted order.
    """
    bucketed = rows.withColumn("_bucket", bucket)
    sizes = bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        bucketed.withColumn("_row", F.row_number().over(inside))
        .join(offsets, [*keys, "_bucket"])
        .withColumn(name, (F.col("_offset") + F.col("_row") - 1).cast("long"))
        .drop("_bucket", "_row", "_offset")
    )
