"""Suspected infection windows, score rises inside them, and onset times.

Everything is reduced to hours before any range join, so work stays linear in the events:
cultures become one row per (subject, hour), scores one summary per (key, hour), and a
window of at most four days meets a bounded number of either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.clock import day_of, days_covering, hour_of
from wardline.functions.items import ANTIBIOTICS, CULTURE_SPECIMENS

# The culture may precede the drug by 72 h or follow it by 24 h.
HOURS_BEFORE = 72
HOURS_AFTER = 24
# Starting minimum of the rise, and the rise that marks onset.
START_MINIMUM = 99
ONSET_RISE = 2


def suspected_cultures(cultures: DataFrame, specimens: Sequence[int] = CULTURE_SPECIMENS) -> DataFrame:
    """Cultures with a time, an organism and a listed specimen."""
    return cultures.where(
        F.col("charttime").isNotNull()
        & F.col("org_name").isNotNull()
        & F.col("spec_itemid").isin(*specimens)
    )


def antibiotic_starts(inputs: DataFrame, d_items: DataFrame, stays: DataFrame | None = None) -> DataFrame:
    """Inputs whose item is an antibiotic; with ``stays``, only subjects that have a stay."""
    # filtered first, so only the drug rows of the dictionary take part in the join; the planner would broadcast a long
    # dictionary by its packed size, so it meets the items in use, of which few are left for the join with the inputs
    drugs = d_items.where(F.col("category") == ANTIBIOTICS).select("itemid")
    used = inputs.select("itemid").distinct().join(drugs.hint("merge"), "itemid", "left_semi")
    found = inputs.join(used, "itemid", "left_semi")
    if stays is not None:
        found = found.join(stays.select("subject_id"), "subject_id", "left_semi")
    return found


def infection_windows(
    antibiotics: DataFrame, cultures: DataFrame, keys: Sequence[str] = ("subject_id",)
) -> DataFrame:
    """Distinct (keys, culture hour, antibiotic start) with the two close enough in time.

    The accepted span around a start is longer than an hour, so whether any culture of an
    hour falls inside it follows from the first and last culture of that hour.
    """
    starts = antibiotics.select(*keys, "starttime").distinct()
    culture_hours = (
        cultures.groupBy("subject_id", hour_of(F.col("charttime")).alias("charttime"))
        .agg(F.min("charttime").alias("_first"), F.max("charttime").alias("_last"))
        .withColumn("_day", day_of(F.col("charttime")))
    )
    earliest = F.col("starttime") - F.expr(f"INTERVAL {HOURS_BEFORE} HOURS")
    latest = F.col("starttime") + F.expr(f"INTERVAL {HOURS_AFTER} HOURS")
    start_days = starts.where(F.col("starttime").isNotNull()).withColumn(
        "_day", F.explode(days_covering(hour_of(earliest), latest))
    )
    # not broadcast, as sizes are guessed without the rows that days are written out to
    return (
        start_days.join(culture_hours.hint("merge"), ["subject_id", "_day"])
        .where((F.col("_last") >= earliest) & (F.col("_first") <= latest))
        .select(*keys, "charttime", "starttime")
    )


def latest_windows(windows: DataFrame, keys: Sequence[str] = ("subject_id",)) -> DataFrame:
    """The longest window of each culture hour; rises can only grow with the window."""
    return windows.groupBy(*keys, "charttime").agg(F.max("starttime").alias("starttime"))


def _rise(value: Column, earlier_minimum: Column) -> Column:
    floor = F.least(F.coalesce(earlier_minimum, F.lit(START_MINIMUM)), F.lit(START_MINIMUM))
    return F.greatest(value - floor, F.lit(0))


def running_rise(
    scores: DataFrame, keys: Sequence[str], order: Sequence[str], score: str = "score"
) -> DataFrame:
    """Adds ``rise``: how far each score is above the minimum before it in its group."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return scores.withColumn("rise", _rise(F.col(score), F.min(score).over(before)))


def max_rise(ordered_scores: Column) -> Column:
    """Largest rise above an earlier minimum, over a short ordered array of scores."""
    start = F.struct(F.lit(START_MINIMUM).alias("low"), F.lit(0).alias("rise"))

    def step(state: Column, value: Column) -> Column:
        return F.struct(
            F.least(state["low"], value).alias("low"),
            F.greatest(state["rise"], value - state["low"]).alias("rise"),
        )

    return F.aggregate(ordered_scores, start, step, lambda state: state["rise"])


def _hourly(scores: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Lowest and highest score and largest rise of every (keys, _hour)."""
    return (
        running_rise(scores, [*keys, "_hour"], order)
        .groupBy(*keys, "_hour")
        .agg(F.min("score").alias("low"), F.max("score").alias("high"), F.max("rise").alias("rise"))
    )


def _across_hours(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summary of ordered hour pieces: a rise lies inside a piece or ends in a later one."""
    before = Window.partitionBy(*keys).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    return (
        pieces.withColumn("_across", _rise(F.col("high"), F.min("low").over(before)))
        .groupBy(*keys)
        .agg(
            F.max("high").alias("max_score"),
            F.min("low").alias("min_score"),
            F.max(F.greatest("rise", "_across")).alias("rise"),
        )
    )


def score_history(scores: DataFrame, keys: Sequence[str] = ("subject_id", "icustay_id")) -> DataFrame:
    """Highest and lowest score and largest rise over the whole history of each key.

    Scores are ordered inside their hour only; a key's window then sees one row per hour.
    """
    hours = scores.where(F.col("score").isNotNull()).withColumn("_hour", hour_of(F.col("starttime")))
    return _across_hours(_hourly(hours, keys, ["starttime", "icustay_id", "score"]), keys)


def _pieces(scores: DataFrame, windows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Score summaries of whole hours, and of the cut hour in which each window ends."""
    hour = hour_of(F.col("starttime")).alias("_hour")
    marked = scores.where(F.col("starttime").isNotNull() & F.col("score").isNotNull()).select(
        *keys, hour, "starttime", F.col("icustay_id").alias("_stay"), "score", F.lit(0).alias("_end")
    )
    ends = windows.select(
        *keys, hour, "starttime", F.lit(None).cast("long").alias("_stay"),
        F.lit(None).cast("int").alias("score"), F.lit(1).alias("_end"),
    ).distinct()

    whole = _hourly(marked, keys, ["starttime", "_stay", "score"])
    # An end mark sorts after the scores of its own instant, so its running summary covers them.
    within = (
        Window.partitionBy(*keys, "_hour")
        .orderBy("starttime", "_end", "_stay", "score")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cut = (
        running_rise(marked.unionByName(ends), [*keys, "_hour"], ["starttime", "_end", "_stay", "score"])
        .withColumn("low", F.min("score").over(within))
        .withColumn("high", F.max("score").over(within))
        .withColumn("rise", F.max(F.when(F.col("_end") == 0, F.col("rise"))).over(within))
        .where((F.col("_end") == 1) & F.col("low").isNotNull())
        .select(*keys, "starttime", "_hour", "low", "high", "rise")
    )
    return whole, cut


def score_windows(
    windows: DataFrame, scores: DataFrame, keys: Sequence[str] = ("subject_id",)
) -> DataFrame:
    """Highest and lowest score and largest rise from culture hour to antibiotic start.

    Windows without a score are dropped. ``scores`` has ``keys``, icustay_id, starttime and
    an integer score; equal times are ordered by stay id, then score.
    """
    whole, cut = _pieces(scores, windows, keys)
    window_keys = [*keys, "charttime", "starttime"]
    end_hour = hour_of(F.col("starttime"))

    spans = windows.where(F.col("charttime") < end_hour).withColumn(
        "_day", F.explode(days_covering(F.col("charttime"), F.col("starttime")))
    )
    inner = (
        spans.join(whole.withColumn("_day", day_of(F.col("_hour"))).hint("merge"), [*keys, "_day"])
        .where((F.col("_hour") >= F.col("charttime")) & (F.col("_hour") < end_hour))
        .select(*window_keys, "_hour", "low", "high", "rise")
    )
    last = windows.where(F.col("charttime") <= end_hour).join(cut, [*keys, "starttime"]).select(
        *window_keys, "_hour", "low", "high", "rise"
    )
    return _across_hours(inner.unionByName(last), window_keys)


def onset(
    windows: DataFrame,
    scores: DataFrame,
    keys: Sequence[str] = ("subject_id",),
    min_rise: int = ONSET_RISE,
) -> DataFrame:
    """Earliest culture hour of a window whose score rises enough, per ``keys``."""
    summary = score_windows(latest_windows(windows, keys), scores, keys)
    return (
        summary.where(F.col("rise") >= min_rise)
        .groupBy(*keys)
        .agg(F.min("charttime").alias("charttime"))
    )
