"""Stay bounds, ages and the event-in-stay join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.clock import day_of, days_covering, hour_of, nearest_hour, years_between

ADULT_YEARS = 15
SHIFTED_AGE_YEARS = 150


def adult_stays(stays: DataFrame, patients: DataFrame) -> DataFrame:
    """Stays of subjects older than 15 at admission, with ``age`` in years."""
    aged = stays.join(patients.select("subject_id", "dob"), "subject_id")
    return (
        aged.withColumn("age", years_between(F.col("dob"), F.col("intime")))
        .where(F.col("age") > ADULT_YEARS)
        .drop("dob")
    )


def stay_bounds(stays: DataFrame) -> DataFrame:
    """Hourly bounds: admission is cut to its hour, discharge goes to the nearest hour."""
    return stays.select(
        "subject_id",
        "icustay_id",
        hour_of(F.col("intime")).alias("intime"),
        nearest_hour(F.col("outtime")).alias("outtime"),
    )


def in_stay(events: DataFrame, stays: DataFrame, time: str = "charttime") -> DataFrame:
    """Events inside a stay of their subject, both ends included, on raw bounds.

    The join key is (subject, day), so a subject with a long history is spread over its
    days. The day is not part of any later grouping, hence the join keeps its own exchange
    and adaptive skew splitting can cut a hot (subject, day) further. Neither side
    is broadcast: the planner guesses sizes without the rows that days and items are written
    out to. Overlapping stays repeat the event.
    """
    stay_days = (
        stays.where(F.col("intime") <= F.col("outtime"))
        .withColumn("_day", F.explode(days_covering(F.col("intime"), F.col("outtime"))))
    )
    dated = events.withColumn("_day", day_of(F.col(time)))
    return (
        dated.join(stay_days.hint("merge"), ["subject_id", "_day"])
        .where((F.col(time) >= F.col("intime")) & (F.col(time) <= F.col("outtime")))
        .drop("_day")
    )
