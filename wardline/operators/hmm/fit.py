"""Emission fits and transition counts from labelled or weighted steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.hmm.chunks import CHUNK_STEPS, KEYS
from wardline.operators.hmm.model import Mixture, literals


def initial_states(labelled: DataFrame) -> DataFrame:
    """(state, n): states of the first steps."""
    firsts = labelled.groupBy("seq_id").agg(F.min_by("state", "t").alias("state"))
    return firsts.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def transition_counts(labelled: DataFrame, chunk_steps: int = CHUNK_STEPS) -> DataFrame:
    """(state, next_state, n) over neighbouring steps of each sequence.

    Neighbours are found inside chunks; a sequence-wide window sees one row per chunk.
    """
    marked = labelled.select(
        "seq_id", "t", "state", F.floor(F.col("t") / chunk_steps).alias("chunk")
    )
    following = F.lead("state").over(Window.partitionBy(*KEYS).orderBy("t"))
    inside = marked.select("state", following.alias("next_state")).where("next_state is not null")
    ends = marked.groupBy(*KEYS).agg(
        F.max_by("state", "t").alias("state"), F.min_by("state", "t").alias("_first")
    )
    next_first = F.lead("_first").over(Window.partitionBy("seq_id").orderBy("chunk"))
    across = ends.select("state", next_first.alias("next_state")).where("next_state is not null")
    return (
        inside.unionByName(across).groupBy("state", "next_state").agg(F.count(F.lit(1)).alias("n"))
    )


def fit_table(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """(state, value, probability): weighted share of each value of ``obs`` in its state."""
    w = F.col(weight) if weight else F.lit(1.0)
    sums = rows.groupBy("state", F.col("obs").alias("value")).agg(F.sum(w).alias("_w"))
    totals = sums.groupBy("state").agg(F.sum("_w").alias("_total"))
    return sums.join(totals, "state").select(
        "state", "value", (F.col("_w") / F.col("_total")).alias("probability")
    )


def fit_gaussian(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """(state, mean, variance): weighted mean and population variance of ``obs``.

    Squares are summed around the state's mean, so large values lose no digits.
    """
    weighed = rows.select("state", F.col("obs").alias("x"), (F.col(weight) if weight else F.lit(1.0)).alias("w"))
    means = weighed.groupBy("state").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("mean"))
    off = F.col("x") - F.col("mean")
    return weighed.join(means, "state").groupBy("state", "mean").agg((F.sum(F.col("w") * off * off) / F.sum("w")).alias("variance"))


def fit_multi(rows: DataFrame) -> DataFrame:
    """(state, i, j, mean_i, mean_j, covariance) of the vectors in ``obs``, j from i upwards.

    Each task folds its rows into count, mean and centred products per state; only those are
    shuffled. Moments are merged around their means, so large values lose no digits.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for state, part in batch.groupby("state"):
                x = np.stack(part["obs"].to_numpy())
                n, mean = float(len(x)), x.mean(axis=0)
                products = (x - mean).T @ (x - mean)
                if state in held:
                    n0, mean0, products0 = held[state]
                    shift, whole = mean - mean0, n0 + n
                    products += products0 + np.outer(shift, shift) * (n0 * n / whole)
                    n, mean = whole, mean0 + shift * (n / whole)
                held[state] = (n, mean, products)
        if held:
            yield pd.DataFrame(
                {"state": list(held), "n": [n for n, _, _ in held.values()], "mean": [m for _, m, _ in held.values()],
                 "c": [c.ravel() for _, _, c in held.values()]}
            )

    partial = rows.select(F.col("state").cast("long").alias("state"), "obs").mapInPandas(
        moments, "state long, n double, mean array<double>, c array<double>"
    )
    i, j = F.floor(F.col("p") / F.size("mean")).cast("int"), (F.col("p") % F.size("mean")).cast("int")
    cells = (
        partial.select("state", "n", "mean", F.posexplode("c").alias("p", "c"))
        .select("state", i.alias("i"), j.alias("j"), F.struct("n", F.get("mean", i).alias("mi"), F.get("mean", j).alias("mj"), "c").alias("part"))
        .where("j >= i")
    )

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        di, dj = b["mi"] - a["mi"], b["mj"] - a["mj"]
        return F.struct(
            n.alias("n"), (a["mi"] + di * b["n"] / n).alias("mi"), (a["mj"] + dj * b["n"] / n).alias("mj"),
            (a["c"] + b["c"] + di * dj * a["n"] * b["n"] / n).alias("c"),
        )

    # one part for each task and state
    start = F.struct(*[F.lit(0.0).alias(x) for x in ("n", "mi", "mj", "c")])
    whole = cells.groupBy("state", "i", "j").agg(F.aggregate(F.collect_list("part"), start, merge).alias("m"))
    return whole.select("state", "i", "j", F.col("m.mi").alias("mean_i"), F.col("m.mj").alias("mean_j"), (F.col("m.c") / F.col("m.n")).alias("covariance"))


def fit_mixture_step(rows: DataFrame, mixture: Mixture, weight: str | None = None) -> DataFrame:
    """(component, weight, mean, variance) after one expectation step over ``obs``.

    Variances are taken around the old means.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    terms = mixture.terms(F.col("obs"), literals(mixture))
    sums = rows.agg(*[F.sum(w * t).alias(f"s{i}") for i, t in enumerate(terms)])
    n = len(mixture.means)
    whole = sum((F.col(f"s{3 * c}") for c in range(1, n)), F.col("s0"))
    out = [
        F.struct(
            F.lit(c).alias("component"),
            (F.col(f"s{3 * c}") / whole).alias("weight"),
            (F.lit(mixture.means[c]) + F.col(f"s{3 * c + 1}") / F.col(f"s{3 * c}")).alias("mean"),
            (F.col(f"s{3 * c + 2}") / F.col(f"s{3 * c}")).alias("variance"),
        )
        for c in range(n)
    ]
    return sums.select(F.inline(F.array(*out)))
