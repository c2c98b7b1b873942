"""Patient sets: intersections, complements, overlaps, per-stay summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def subjects(rows: DataFrame) -> DataFrame:
    return rows.select("subject_id").distinct()


def common_subjects(*tables: DataFrame) -> DataFrame:
    """Subjects present in every table, from one grouped pass over tagged ids."""
    tagged = [subjects(t).withColumn("_table", F.lit(n)) for n, t in enumerate(tables)]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    return (
        union.groupBy("subject_id")
        .agg(F.count(F.lit(1)).alias("_tables"))
        .where(F.col("_tables") == len(tables))
        .select("subject_id")
    )


def keep_common(*tables: DataFrame) -> list[DataFrame]:
    """Each table restricted to the subjects present in all of them."""
    common = common_subjects(*tables)
    return [t.join(common, "subject_id", "left_semi") for t in tables]


def non_septic(stays: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct subjects with a stay and no label."""
    return subjects(stays.join(labels.select("subject_id"), "subject_id", "left_anti"))


def cohort_overlap(cohorts: Mapping[str, DataFrame], key: str = "subject_id") -> DataFrame:
    """For each pair of cohorts, the shares of their union in both, only left, only right.

    One grouped pass flags every id; all pairings are sums over the flags. An empty union
    gives null shares.
    """
    names = list(cohorts)
    union = None
    for name in names:
        ids = cohorts[name].select(
            F.col(key).alias("_id"), *[F.lit(int(n == name)).alias(n) for n in names]
        )
        union = ids if union is None else union.unionByName(ids)
    flags = union.groupBy("_id").agg(*[F.max(n).alias(n) for n in names])

    totals = []
    rows = []
    for left, right in combinations(names, 2):
        tag = f"{left}__{right}"
        lf, rf = F.col(left), F.col(right)
        totals += [
            F.sum(lf * rf).alias(f"{tag}__both"),
            F.sum(lf * (1 - rf)).alias(f"{tag}__left"),
            F.sum(rf * (1 - lf)).alias(f"{tag}__right"),
        ]
        rows.append(
            F.struct(
                F.lit(left).alias("left_cohort"),
                F.lit(right).alias("right_cohort"),
                *[F.col(f"{tag}__{p}").cast("double").alias(p) for p in ("both", "left", "right")],
            )
        )
    total = F.nullif(F.col("r.both") + F.col("r.left") + F.col("r.right"), F.lit(0.0))
    return (
        flags.agg(*totals)
        .select(F.explode(F.array(*rows)).alias("r"))
        .select(
            "r.left_cohort",
            "r.right_cohort",
            (F.col("r.both") / total).alias("both_share"),
            (F.col("r.left") / total).alias("left_share"),
            (F.col("r.right") / total).alias("right_share"),
        )
    )


def stay_labels(matrix: DataFrame) -> DataFrame:
    """One label per stay: that of its last hour."""
    return matrix.groupBy("icustay_id").agg(F.max_by("label", "charttime").alias("label"))


def stay_lengths(matrix: DataFrame, min_length: int = 1) -> DataFrame:
    """Hours per stay, keeping stays of at least ``min_length`` hours."""
    return (
        matrix.groupBy("icustay_id")
        .agg(F.count(F.lit(1)).alias("n_hours"))
        .where(F.col("n_hours") >= min_length)
    )


def long_sequences(steps: DataFrame, values: str, width: int = 8, min_length: int = 7) -> DataFrame:
    """Steps of sequences whose every vector has ``width`` values and that are long enough."""
    good = (
        steps.groupBy("seq_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(F.size(values)).alias("_min"),
            F.max(F.size(values)).alias("_max"),
        )
        .where((F.col("_n") >= min_length) & (F.col("_min") == width) & (F.col("_max") == width))
        .select("seq_id")
    )
    return steps.join(good, "seq_id", "left_semi")


def stay_sequences(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature vectors of each stay in time order, with their number.

    A stay has one row per hour, so an array is bounded by the stay's duration.
    """
    step = F.struct("charttime", F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    return (
        matrix.groupBy("icustay_id")
        .agg(F.sort_array(F.collect_list(step)).alias("_steps"))
        .select(
            "icustay_id",
            F.transform("_steps", lambda s: s["x"]).alias("sequence"),
            F.size("_steps").alias("length"),
        )
    )
