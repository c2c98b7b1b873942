"""Dense hourly grids, gap filling and the labelled matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.clock import micros
from wardline.functions.items import GCS_PARTS, VITALS

HOUR_MICROS = 3_600_000_000
STAY = ("subject_id", "icustay_id")
STAY_HOUR = (*STAY, "charttime")
MATRIX_VITALS = tuple(v for v in VITALS if v not in GCS_PARTS)


def _last_step(start: Column, end: Column) -> Column:
    """Hours from the first grid point to the last."""
    span = (micros(end) - micros(start)) / F.lit(HOUR_MICROS)
    return F.greatest(F.ceil(span), F.lit(0)).cast("int")


def hourly_grid(bounds: DataFrame) -> DataFrame:
    """Hours of each stay from ``intime`` up to the first point at or after ``outtime``.

    Stays with a missing bound are dropped; a stay that ends before it starts has one point.
    """
    steps = _last_step(F.col("intime"), F.col("outtime"))
    return (
        bounds.where(F.col("intime").isNotNull() & F.col("outtime").isNotNull())
        .withColumn("_step", F.explode(F.sequence(F.lit(0), steps)))
        .select(
            *STAY,
            (F.col("intime") + F.expr("make_dt_interval(0, _step)")).alias("charttime"),
        )
    )


def on_grid(grid: DataFrame, features: DataFrame) -> DataFrame:
    """Grid hours with the features charted at exactly that hour, else nulls."""
    return grid.join(features, list(STAY_HOUR), "left")


def with_labels(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``label`` 1 at the exact onset hour, 0 elsewhere; not carried forward."""
    if labels is None:
        return rows.withColumn("label", F.lit(0))
    marks = labels.select(*STAY_HOUR, F.lit(1).alias("label"))
    joined = rows.join(marks, list(STAY_HOUR), "left")
    return joined.withColumn("label", F.coalesce("label", F.lit(0)))


def fill_forward(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Last known value of each column within the stay.

    A stay has one row per hour, so its window is bounded by its duration.
    """
    past = Window.partitionBy(*STAY).orderBy("charttime").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(past) for c in columns})


def fill_both(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Forward fill, then backward fill of what is still missing at the start.

    Only the leading gap stays empty after the forward pass and its filler is the first
    known value of the whole stay, so both passes share one shuffle and one sort.
    """
    by_time = Window.partitionBy(*STAY).orderBy("charttime")
    past = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumns(
        {
            c: F.coalesce(
                F.last(c, ignorenulls=True).over(past),
                F.first(c, ignorenulls=True).over(whole),
            )
            for c in columns
        }
    )


def complete_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.dropna(how="any", subset=["charttime", *columns])


def labelled_matrix(
    features: DataFrame, bounds: DataFrame, labels: DataFrame | None = None
) -> DataFrame:
    """Complete, gap-filled stay hours with a label and one summed coma score.

    Same rows as grid, left joins, fills and the complete-row filter one after the other,
    but filled values only change where something was charted. So the charted hours are
    filled first; each then stands for the hours up to the next one, the first also for the
    hours before it. Hours are written out last: only charted rows and one row per stay are
    shuffled, all on the stay.
    """
    columns = [*VITALS, "age"]
    stays = bounds.where(F.col("intime").isNotNull() & F.col("outtime").isNotNull()).select(
        *STAY, "intime", _last_step(F.col("intime"), F.col("outtime")).alias("_last")
    )
    past_in = micros(F.col("charttime")) - micros(F.col("intime"))
    charted = (
        stays.join(features.select(*STAY_HOUR, *columns), list(STAY))
        .withColumn("_step", F.floor(past_in / F.lit(HOUR_MICROS)).cast("int"))
        .where((past_in % F.lit(HOUR_MICROS) == 0) & F.col("_step").between(0, F.col("_last")))
    )
    by_step = Window.partitionBy(*STAY).orderBy("_step")
    marked = charted.withColumns(
        {"_row": F.row_number().over(by_step), "_next": F.lead("_step").over(by_step)}
    )
    first = F.when(F.col("_row") == 1, F.lit(0)).otherwise(F.col("_step"))
    last = F.when(F.col("_next").isNull(), F.col("_last")).otherwise(
        F.greatest("_step", F.col("_next") - 1)
    )
    spans = complete_rows(
        fill_both(marked, columns).withColumn("_hours", F.sequence(first, last)), columns
    )
    coma = sum((F.col(c) for c in GCS_PARTS[1:]), F.col(GCS_PARTS[0]))
    label = F.lit(0)
    if labels is not None:
        spans = _mark_labels(spans, labels)
        label = F.array_contains("_labels", F.col("_step")).cast("int")
    return (
        spans.select(
            *STAY, "intime", "_labels" if labels is not None else F.lit(None).alias("_labels"),
            *MATRIX_VITALS, coma.alias("gcs"), "age", F.explode("_hours").alias("_step"),
        )
        .select(
            *STAY,
            (F.col("intime") + F.expr("make_dt_interval(0, _step)")).alias("charttime"),
            label.alias("label"), *MATRIX_VITALS, "gcs", "age",
        )
    )


def _mark_labels(spans: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``_labels``, the labelled steps of the stay; a repeated label repeats its hour."""
    marks = (
        labels.where(F.col("charttime").isNotNull())
        .groupBy(*STAY_HOUR)
        .agg(F.count(F.lit(1)).cast("int").alias("n"))
        .groupBy(*STAY)
        .agg(F.collect_list(F.struct("charttime", "n")).alias("_marks"))
    )
    past_in = lambda m: micros(m["charttime"]) - micros(F.col("intime"))
    on_hour = F.filter("_marks", lambda m: past_in(m) % F.lit(HOUR_MICROS) == 0)
    step = lambda m: F.floor(past_in(m) / F.lit(HOUR_MICROS)).cast("int")
    joined = spans.join(marks, list(STAY), "left")
    none = F.expr("cast(array() as array<int>)")
    return joined.withColumns(
        {
            "_labels": F.coalesce(F.transform(on_hour, step), none),
            "_more": F.coalesce(
                F.flatten(F.transform(on_hour, lambda m: F.array_repeat(step(m), m["n"] - 1))), none
            ),
        }
    ).withColumn(
        "_hours", F.concat("_hours", F.filter("_more", lambda h: F.array_contains("_hours", h)))
    )
