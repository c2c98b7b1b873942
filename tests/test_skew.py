"""Plans under a key that holds a third of the rows, with nothing small enough to broadcast."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardline.functions import items
from wardline.operators import onset
from wardline.operators.features import wide_hours
from wardline.operators.stays import in_stay

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def settings(spark, **changes):
    before = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    n = 60_000
    # a third of all rows fall on subject 1 within one day
    events = spark.range(n).repartition(16).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 10).alias("subject_id"),
        F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, cast(id % 1400 as int))").alias("charttime"),
        F.lit(220045).alias("itemid"), (F.col("id") % 90 + 1).cast("double").alias("valuenum"),
    )
    stays = spark.range(510).select(
        F.col("id").alias("subject_id"), (F.col("id") * 10).alias("icustay_id"),
        F.lit(datetime(2019, 12, 31)).cast("timestamp_ntz").alias("intime"),
        F.lit(datetime(2020, 1, 3)).cast("timestamp_ntz").alias("outtime"),
    )
    return events, stays


def test_hot_stay_join_is_split(spark, hot):
    events, stays = hot
    with settings(spark, **SETTINGS):
        joined = in_stay(events, stays).select("icustay_id", "valuenum")
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 60_000


def test_hot_features_are_split_and_summed_before_the_next_shuffle(spark, hot):
    events, stays = hot
    with settings(spark, **SETTINGS):
        wide = wide_hours(events, stays, {"heart_rate": (items.HEART_RATE,)})
        plan = final_plan(wide)
        assert "skew=true" in plan and "partial_avg" in plan


def test_hot_subject_windows_stay_linear(spark):
    """One subject with dense cultures, drugs and scores: pairs are bounded by hours, not by rows."""
    n = 4_000
    times = F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, cast(id % 6000 as int), cast(id % 60 as int))")
    cultures = spark.range(n).select(F.lit(1).alias("subject_id"), times.alias("charttime"))
    drugs = spark.range(n).select(F.lit(1).alias("subject_id"), times.alias("starttime"))
    scores = spark.range(n).select(
        F.lit(1).alias("subject_id"), F.lit(10).cast("long").alias("icustay_id"), times.alias("starttime"),
        (F.col("id") * 7919 % 20).cast("int").alias("score"),
    )
    windows = onset.infection_windows(drugs, cultures)
    # at most 98 culture hours lie in reach of a drug, however many cultures there are
    assert windows.count() <= 98 * n
    first = onset.onset(windows, scores).collect()
    assert [r["charttime"] for r in first] == [datetime(2020, 1, 1)]
