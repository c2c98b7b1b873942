from __future__ import annotations

import random
from datetime import datetime, timedelta

from wardline.functions.items import VITALS
from wardline.operators import grid
from wardline.operators.stays import stay_bounds

T = datetime(2020, 1, 1, 10)
BOUNDS = "subject_id long, icustay_id long, intime timestamp_ntz, outtime timestamp_ntz"
WIDE = (
    "subject_id long, icustay_id long, charttime timestamp_ntz, "
    + ", ".join(f"{v} double" for v in VITALS) + ", age int"
)


def hours(spark, *bounds):
    rows = [(1, 10 + n, a, b) for n, (a, b) in enumerate(bounds)]
    got = grid.hourly_grid(spark.createDataFrame(rows, BOUNDS)).collect()
    out: dict[int, list[datetime]] = {}
    for r in got:
        out.setdefault(r["icustay_id"], []).append(r["charttime"])
    return {k: sorted(v) for k, v in out.items()}


def test_grid_points(spark):
    got = hours(
        spark,
        (T, T + timedelta(hours=3)),
        (T, T),
        (T, T - timedelta(hours=2)),
        (T, T + timedelta(hours=1, minutes=1)),
        (T, None),
        (None, T),
    )
    assert got == {
        10: [T + timedelta(hours=h) for h in range(4)],
        11: [T],
        12: [T],
        13: [T, T + timedelta(hours=1), T + timedelta(hours=2)],
    }


def test_bounds_are_cut_and_rounded(spark):
    rows = [(1, 1, T + timedelta(minutes=50), T + timedelta(hours=2, minutes=29)),
            (1, 2, T + timedelta(minutes=50), T + timedelta(hours=2, minutes=30))]
    got = {r["icustay_id"]: (r["intime"], r["outtime"]) for r in stay_bounds(spark.createDataFrame(rows, BOUNDS)).collect()}
    assert got == {1: (T, T + timedelta(hours=2)), 2: (T, T + timedelta(hours=3))}


def wide(spark, rows):
    """rows: (hour, {column: value}) of stay 10."""
    data = []
    for h, values in rows:
        data.append((1, 10, T + timedelta(hours=h), *[values.get(v) for v in VITALS], values.get("age")))
    return spark.createDataFrame(data, WIDE)


def test_fill_both_ways(spark):
    rows = wide(spark, [(0, {}), (1, {"bp_dia": 5.0, "age": 40}), (2, {}), (3, {"bp_dia": 7.0}), (4, {})])
    forward = grid.fill_forward(rows, ["bp_dia", "age"]).orderBy("charttime").collect()
    assert [r["bp_dia"] for r in forward] == [None, 5.0, 5.0, 7.0, 7.0]
    both = grid.fill_both(rows, ["bp_dia", "bp_sys", "age"]).orderBy("charttime").collect()
    assert [r["bp_dia"] for r in both] == [5.0, 5.0, 5.0, 7.0, 7.0]
    assert [r["age"] for r in both] == [40] * 5
    assert [r["bp_sys"] for r in both] == [None] * 5


def test_matrix_labels_exact_hour_sums_coma_score_and_drops_incomplete(spark):
    full = {v: float(n + 1) for n, v in enumerate(VITALS)} | {"age": 40}
    features = wide(spark, [(1, full)])
    bounds = spark.createDataFrame([(1, 10, T, T + timedelta(hours=3)), (1, 11, T, T)], BOUNDS)
    labels = spark.createDataFrame([(1, 10, T + timedelta(hours=2))], "subject_id long, icustay_id long, charttime timestamp_ntz")
    got = grid.labelled_matrix(features, bounds, labels).orderBy("charttime").collect()
    assert [r["label"] for r in got] == [0, 0, 1, 0]
    assert {r["gcs"] for r in got} == {7.0 + 8.0 + 9.0}
    assert {r["icustay_id"] for r in got} == {10}
    assert {r["label"] for r in grid.labelled_matrix(features, bounds).collect()} == {0}


def test_matrix_equals_its_steps_and_repeats_hours_of_repeated_labels(spark):
    rnd = random.Random(3)
    rows, bounds, labels = [], [], []
    for stay in range(30):
        start = T + timedelta(hours=rnd.randint(0, 5), minutes=30 * (stay % 7 == 0))
        n = rnd.randint(0, 30)
        bounds.append((1, stay, start, start + timedelta(hours=n, minutes=rnd.choice([0, 10]))))
        for h in sorted(rnd.sample(range(-3, n + 4), rnd.randint(0, n + 4))):
            values = [rnd.choice([None, None, float(h)]) for _ in VITALS]
            rows.append((1, stay, start + timedelta(hours=h, minutes=rnd.choice([0, 0, 0, 15])), *values, 50))
        for _ in range(rnd.randint(0, 3)):
            label = (1, stay, start + timedelta(hours=rnd.randint(-2, n + 2)))
            labels += [label] * rnd.randint(1, 3)
    features = spark.createDataFrame(rows, WIDE)
    b = spark.createDataFrame(bounds, BOUNDS)
    lab = spark.createDataFrame(labels, "subject_id long, icustay_id long, charttime timestamp_ntz")
    columns = [*VITALS, "age"]
    for given in (lab, None):
        long_way = grid.complete_rows(
            grid.fill_both(grid.with_labels(grid.on_grid(grid.hourly_grid(b), features), given), columns), columns
        )
        want = long_way.selectExpr(
            "icustay_id", "charttime", "label", "bp_dia", "spo2", "eye_opening + verbal + motor as gcs", "age"
        )
        got = grid.labelled_matrix(features, b, given).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert want.count() > 50


def test_a_sample_filters_where_tables_are_read(spark):
    from wardline.plans.bindings import Ward

    ward = Ward(spark, "/root/testdata/sf0.001")
    drawn = spark.createDataFrame([(1,), (7,)], "subject_id long")
    few = ward.restricted(drawn)
    whole = {tuple(r) for r in ward.matrix.where("subject_id IN (1, 7)").collect()}
    assert {tuple(r) for r in few.matrix.collect()} == whole
    plan = few.features._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2  # events and stays
