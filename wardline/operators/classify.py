"""Elastic-net logistic models on the labelled matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import cut_lineage

FEATURES = ("bp_dia", "bp_sys", "heart_rate", "resp_rate", "temp_f", "spo2", "gcs", "age")
# Settings of the two models.
ELASTIC_NET_MIX = 0.15
BATCH_ITERATIONS = 10
BATCH_THRESHOLD = 0.1
SGD_PASSES = 2
SGD_PENALTY = 1e-4
#: Rows of a shard that one task goes through in turn.
SGD_SHARD_ROWS = 200_000


def _assembled(matrix: DataFrame, features: Sequence[str]) -> DataFrame:
    rows = VectorAssembler(inputCols=list(features), outputCol="features").transform(matrix)
    return rows.withColumn("label", F.col("label").cast("double"))


def _fit(lr: LogisticRegression, rows: DataFrame) -> LogisticRegressionModel:
    """A fit passes over its input more than once; keep the input, not the plan behind it."""
    training = rows.select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return lr.fit(training)
    finally:
        training.unpersist()


def fit_elastic_net(matrix: DataFrame, features: Sequence[str] = FEATURES) -> LogisticRegressionModel:
    """Ten iterations, no standardisation, low threshold; without a penalty the mix is idle."""
    lr = LogisticRegression(
        maxIter=BATCH_ITERATIONS,
        elasticNetParam=ELASTIC_NET_MIX,
        standardization=False,
        threshold=BATCH_THRESHOLD,
    )
    return _fit(lr, _assembled(matrix, features))


def coefficients(model: LogisticRegressionModel, rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, coefficient) with the intercept, a row per feature."""
    values = [("intercept", float(model.intercept))]
    values += [(f, float(c)) for f, c in zip(features, model.coefficients)]
    return rows.sparkSession.createDataFrame(values, "feature string, coefficient double")


def _pass_over(rows: Iterator[np.ndarray], start: np.ndarray, seen: int, alpha: float, mix: float) -> tuple[np.ndarray, int]:
    """One step per row of (label, features...): log loss, then the shrinking and cutting of the penalty.

    The step size falls as 1 / (alpha * (offset + steps)); the intercept, last, has no penalty.
    """
    w, n = start.copy(), 0
    offset = 1.0 / (alpha * math.sqrt(1.0 / math.sqrt(alpha)))
    for block in rows:
        for row in block:
            x = row[1:]
            step = 1.0 / (alpha * (offset + seen + n))
            margin = min(max(float(w[:-1] @ x + w[-1]), -700.0), 700.0)
            error = row[0] - 1.0 / (1.0 + math.exp(-margin))
            inner = w[:-1] * (1.0 - step * alpha * (1.0 - mix)) + step * error * x
            w[:-1] = np.sign(inner) * np.maximum(np.abs(inner) - step * alpha * mix, 0.0)
            w[-1] += step * error
            n += 1
    return w, n


def fit_sgd(
    matrix: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES, passes: int = SGD_PASSES,
    alpha: float = SGD_PENALTY, mix: float = ELASTIC_NET_MIX, shard_rows: int = SGD_SHARD_ROWS,
) -> list[float]:
    """Weights and, last, the intercept after stochastic passes over all rows.

    Rows are dealt by hash of their keys to shards of about ``shard_rows`` and taken in hash order, so
    the result doesn't depend on the layout. Each pass goes through every shard from the same weights,
    one step per row, and the shards' weights are averaged by their rows. With one shard this is plain
    stochastic descent. What comes to the driver is one row of weights per shard.
    """
    place = F.xxhash64(*keys)
    values = [F.col("label").cast("double"), *[F.col(f).cast("double") for f in features]]
    data = matrix.select(place.alias("place"), *keys, F.array(*values).alias("row")).where(F.forall("row", lambda v: v.isNotNull()))
    total = data.count()
    shards = max(1, -(-total // shard_rows))
    dealt = data.withColumn("shard", F.pmod(F.shiftright("place", 8), F.lit(shards))).repartition(shards, "shard")
    ordered = dealt.sortWithinPartitions("shard", "place", *keys).select("shard", "row").persist(StorageLevel.MEMORY_AND_DISK)
    width, weights, seen = len(features) + 1, np.zeros(len(features) + 1), 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, w = None, 0, weights
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            rows = batch.column("row").flatten().to_numpy().reshape(-1, width)
            for at in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
                if len(at) and shard[at[0]] != now:
                    if now is not None:
                        yield _weights_row(w, done)
                    now, done, w = shard[at[0]], 0, weights
                w, n = _pass_over(iter([rows[at]]), w, seen + done, alpha, mix)
                done += n
        if now is not None:
            yield _weights_row(w, done)

    try:
        for _ in range(passes):
            made = ordered.mapInArrow(run, "n long, weights array<double>").collect()
            counts = np.array([r["n"] for r in made], dtype=float)
            if counts.sum() == 0:
                break
            # shards in a fixed order, so sums round alike
            found = sorted((r["n"], r["weights"]) for r in made)
            weights = sum(n * np.array(w) for n, w in found) / counts.sum()
            seen += int(counts.max())
    finally:
        ordered.unpersist()
    return [float(v) for v in weights]


def _weights_row(w: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([w.tolist()], pa.list_(pa.float64()))], names=["n", "weights"])


def sgd_probabilities(
    matrix: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES
) -> DataFrame:
    """Two stochastic passes with an elastic-net penalty, then class probabilities of the training rows.

    The matrix is counted, fitted and scored, so it is written first: what is behind it is planned and run once.
    """
    matrix = cut_lineage(matrix)
    *weights, intercept = fit_sgd(matrix, keys, features)
    margin = F.lit(intercept)
    for f, w in zip(features, weights):
        margin = margin + F.lit(w) * F.col(f).cast("double")
    p = 1.0 / (1.0 + F.exp(-margin))
    return matrix.select(*keys, (1.0 - p).alias("p0"), p.alias("p1"))
