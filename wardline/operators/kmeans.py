"""k-means from fixed seeds: the first k distinct points."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.arrays import literal_array

TOLERANCE = 1e-9
#: Values of points that one task of a round goes through at least.
TASK_VALUES = 1 << 21
#: Sums of more tasks than this are added up by tasks before they reach the driver.
MOST_PARTS = 200


def _nearest(x: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre; ties go to the lower index."""
    distances = []
    for centre in centres:
        c = literal_array(centre)
        squares = F.zip_with(x, c, lambda a, b: (a - b) * (a - b))
        distances.append(F.aggregate(squares, F.lit(0.0), lambda t, v: t + v))
    d = F.array(*distances)
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def first_distinct(points: DataFrame, column: str, order: Sequence[str], k: int) -> list[list[float]]:
    """The k distinct points that come first by ``order``.

    One pass per point, each reduced to a single row inside the tasks, so neither copies nor
    the number of points matter.
    """
    found: list[list[float]] = []
    left = points
    while len(found) < k:
        row = left.agg(F.min_by(column, F.struct(*order)).alias("x")).first()
        if row["x"] is None:
            break
        found.append(list(row["x"]))
        left = left.where(F.col(column) != literal_array(found[-1]))
    return found


def _kept_blocks(points: DataFrame, width: int) -> RDD:
    """The vectors as arrays, kept by the tasks that hold them: a round then plans no query and turns no row into Arrow."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.ascontiguousarray(batch.column(0).flatten().to_numpy(zero_copy_only=False), dtype=float)
            # fails on vectors of unequal length
            yield pa.RecordBatch.from_arrays([pa.array([x.reshape(batch.num_rows, width).tobytes()], pa.binary())], names=["block"])

    # tasks go by the number of values, at least one a core, whatever the number of partitions
    tasks = max(points.sparkSession.sparkContext.defaultParallelism, -(-points.count() * width // TASK_VALUES))
    rows = points.mapInArrow(pack, "block binary").rdd.coalesce(tasks)
    return rows.map(lambda r: np.frombuffer(r["block"]).reshape(-1, width)).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(blocks: RDD, centres: Sequence[Sequence[float]]) -> np.ndarray:
    """Size and vector sum of each cluster; each task folds its points into one array of that shape."""
    held = np.asarray(centres, dtype=float)

    def fold(part: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        k, d = held.shape
        sums = np.zeros((k, d + 1))
        for x in part:
            distances = np.stack([((x - c) ** 2).sum(axis=1) for c in held], axis=1)
            nearest = distances.argmin(axis=1)
            sums[:, 0] += np.bincount(nearest, minlength=k)
            for c in range(k):
                sums[c, 1:] += x[nearest == c].sum(axis=0)
        yield sums

    parts = blocks.mapPartitions(fold)
    if parts.getNumPartitions() > MOST_PARTS:
        return parts.treeReduce(np.add)
    return sum(parts.collect(), np.zeros((held.shape[0], held.shape[1] + 1)))


def kmeans(
    points: DataFrame, column: str, order: Sequence[str], k: int, max_iterations: int = 100
) -> list[list[float]]:
    """Centres after moving points to the nearest centre until the centres stand still.

    Tasks fold their points into one sum per cluster; only those sums are returned, and each
    round adds them up to k vectors at the driver. A centre without points stays.
    """
    points = points.select(column, *order).persist(StorageLevel.MEMORY_AND_DISK)
    blocks = None
    try:
        centres = first_distinct(points, column, order, k)
        blocks = _kept_blocks(points.select(column), len(centres[0]))
        for _ in range(max_iterations):
            sums = _sums(blocks, centres)
            # the blocks are kept from the first round on
            points.unpersist()
            moved = [
                list(s[1:] / s[0]) if s[0] > 0 else list(c) for s, c in zip(sums, centres)
            ]
            shift = max(abs(a - b) for c, m in zip(centres, moved) for a, b in zip(c, m))
            centres = moved
            if shift <= TOLERANCE:
                break
        return centres
    finally:
        points.unpersist()
        if blocks is not None:
            blocks.unpersist()


def assign(points: DataFrame, column: str, centres: Sequence[Sequence[float]]) -> DataFrame:
    return points.withColumn("cluster", _nearest(F.col(column), centres))
