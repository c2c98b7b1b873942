"""Tables that the planner takes for small by their packed size, or without the rows they are written out to, are not broadcast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_bindings import PARTS, ward
from wardline.functions.items import ANTIBIOTICS
from wardline.operators import onset
from wardline.operators.stays import in_stay
from wardline.plans.bindings import ALL_ITEMS, Ward


def planned(df) -> str:
    """The plan as made from guessed sizes."""
    return df._jdf.queryExecution().sparkPlan().toString()


def hours(name: str):
    return F.expr(f"timestamp_ntz'2020-01-01' + make_dt_interval(0, cast(id % 90 as int)) AS {name}")


def test_the_dictionary_does_not_broadcast_the_parts(spark, tmp_path):
    ward(spark, tmp_path)
    id_ = F.col("id")
    parts = spark.range(200_000).select(id_.alias("p_partkey"), *[F.lit("x").alias(c) for c in ("p_name", "p_brand", "p_type")], F.lit(1).alias("p_size"), F.lit(1.0).alias("p_retailprice"))
    parts.write.mode("overwrite").parquet(f"{tmp_path}/part.parquet")
    w = Ward(spark, str(tmp_path))
    listed = w.d_items
    assert sorted(r["itemid"] for r in listed.collect()) == sorted(ALL_ITEMS)
    joins = [x for x in planned(listed).splitlines() if "BroadcastHashJoin" in x]
    assert len(joins) == 1 and "BroadcastHashJoin [p_partkey" in joins[0] and "BuildRight" in joins[0]
    assert [f.name for f in spark.read.parquet(f"{tmp_path}/part.parquet").schema] == [x.split()[0] for x in PARTS.split(", ")]


def test_a_long_list_of_drugs_meets_the_items_in_use(spark):
    drugs = spark.range(400_000).select(F.col("id").alias("itemid"), F.when(F.col("id") % 2 == 0, ANTIBIOTICS).otherwise("Other").alias("category"))
    inputs = spark.range(3_000_000).select((F.col("id") % 7).alias("itemid"), F.col("id").alias("subject_id"), hours("starttime"))
    found = onset.antibiotic_starts(inputs, drugs)
    assert found.count() == sum(1 for i in range(3_000_000) if i % 7 % 2 == 0)
    assert "SortMergeJoin [itemid" in planned(found)


@pytest.mark.parametrize("what", ["stays", "windows", "scores"])
def test_rows_written_out_to_days_are_not_broadcast(spark, what):
    rows = spark.range(3_000).withColumn("subject_id", F.col("id") % 100)
    events = rows.select("subject_id", hours("charttime"))
    if what == "stays":
        joined = in_stay(events, spark.range(100).select(F.col("id").alias("subject_id"), F.expr("timestamp_ntz'2020-01-01' AS intime"), F.expr("timestamp_ntz'2020-01-03' AS outtime")))
        assert joined.count() == rows.where("id % 90 <= 48").count()
    elif what == "windows":
        joined = onset.infection_windows(rows.select("subject_id", hours("starttime")), events)
    else:
        windows = rows.select("subject_id", F.expr("timestamp_ntz'2020-01-01' AS charttime"), hours("starttime"))
        scores = rows.select("subject_id", F.col("id").alias("icustay_id"), hours("starttime"), F.lit(3).alias("score"))
        joined = onset.score_windows(windows, scores)
    assert "SortMergeJoin" in planned(joined) and "_day" not in "".join(x for x in planned(joined).splitlines() if "BroadcastHashJoin" in x)
