"""Repeatable sampling by hashed ids: any cluster layout draws the same sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.ranking import row_index

# Fixed value: the seed of every draw.
SEED = 8803
HASH_RANGE = 2**32


def hash_number(*parts: Column, seed: int = SEED) -> Column:
    """Integer in [0, 2^32) from the first eight hex digits of an md5."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def drawn(*parts: Column, rate: Column | float, seed: int = SEED) -> Column:
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    return hash_number(*parts, seed=seed) < rate * F.lit(float(HASH_RANGE))


def sample_patients(stays: DataFrame, rate: float, seed: int = SEED) -> DataFrame:
    """Distinct subjects with a stay, kept at ``rate``."""
    subjects = stays.select("subject_id").distinct()
    return subjects.where(drawn(F.col("subject_id"), rate=rate, seed=seed))


def sample_strata(
    stays: DataFrame, labels: DataFrame, rate: float, seed: int = SEED
) -> DataFrame:
    """Septic subjects at ``rate``, then others to fill up: (subject_id, septic).

    The others are drawn per *stay* at (n * rate - sampled septic) / n with n their number
    of stays, never below zero, so a subject with many stays is likelier to be drawn.
    """
    septic = labels.select("subject_id").distinct().withColumn("septic", F.lit(1))
    rows = stays.select("subject_id", "icustay_id").join(septic, "subject_id", "full")
    rows = rows.withColumn("septic", F.coalesce("septic", F.lit(0)))
    is_septic = F.col("septic") == 1
    taken = is_septic & drawn(F.col("subject_id"), rate=rate, seed=seed)

    n_others = F.count(F.when(~is_septic, 1)).cast("double")
    n_sampled = F.count_distinct(F.when(taken, F.col("subject_id"))).cast("double")
    fill = F.greatest((n_others * rate - n_sampled) / F.nullif(n_others, F.lit(0.0)), F.lit(0.0))
    # one number, read by the plan as a subquery
    other_rate = rows.agg(fill).scalar()
    filled = ~is_septic & drawn(
        F.col("subject_id"), F.col("icustay_id"), rate=other_rate, seed=seed
    )
    return rows.where(taken | filled).select("subject_id", "septic").distinct()


def stratum_counts(stays: DataFrame, labels: DataFrame) -> DataFrame:
    """Number of septic subjects and of stays of other subjects."""
    septic = labels.select("subject_id").distinct()
    rows = septic.select(F.lit("septic").alias("stratum")).unionByName(
        stays.join(septic, "subject_id", "left_anti").select(F.lit("non_septic").alias("stratum"))
    )
    return rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))


def keep_subjects(rows: DataFrame, subjects: DataFrame) -> DataFrame:
    return rows.join(subjects.select("subject_id"), "subject_id", "left_semi")


def split_sequences(
    sequences: DataFrame, file: str, key: str, share: float = 0.75, seed: int = SEED
) -> DataFrame:
    """Adds ``part`` ('train' or 'test'): round(share * n) sequences of each file train.

    Sequences are ranked by hash; ranks come from :func:`row_index` over hash ranges, so a
    file with most of the sequences is still ranked in parallel.
    """
    hashed = sequences.withColumn("_hash", hash_number(F.col(key), seed=seed))
    ranked = row_index(hashed, [file], F.col("_hash").bitwiseAND(0xFFF00000), ["_hash", key], "_rank")
    sizes = sequences.groupBy(file).agg(F.count(F.lit(1)).alias("_n"))
    # half-way sizes go to the even number
    n_train = F.bround(F.col("_n") * F.lit(share))
    return (
        ranked.join(sizes, file)
        .withColumn("part", F.when(F.col("_rank") < n_train, F.lit("train")).otherwise(F.lit("test")))
        .drop("_hash", "_rank", "_n")
    )
