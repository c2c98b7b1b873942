from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardline.operators import onset

T = datetime(2020, 1, 1)
HOUR = timedelta(hours=1)


def floor_hour(t: datetime) -> datetime:
    return t.replace(minute=0, second=0, microsecond=0)


def brute_windows(antibiotics, cultures):
    out = set()
    for subject, stay, start in antibiotics:
        for other, c in cultures:
            if subject == other and c is not None and -24 * HOUR <= start - c <= 72 * HOUR:
                out.add((subject, stay, floor_hour(c), start))
    return out


def brute_rise(values):
    low, rise = 99, 0
    for v in values:
        rise, low = max(rise, v - low), min(low, v)
    return rise


def tables(spark, antibiotics, cultures, scores):
    return (
        spark.createDataFrame(antibiotics, "subject_id long, icustay_id long, starttime timestamp_ntz"),
        spark.createDataFrame(cultures, "subject_id long, charttime timestamp_ntz"),
        spark.createDataFrame(scores, "subject_id long, icustay_id long, starttime timestamp_ntz, score int"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_scores_and_onset_match_brute_force(spark, seed):
    rnd = random.Random(seed)

    def subject():
        # one subject holds a third of the rows
        return 1 if rnd.random() < 0.34 else rnd.randint(2, 6)

    def time():
        # quarter hours, so that equal times and hour edges occur
        return T + timedelta(minutes=15 * rnd.randint(0, 10 * 96))

    antibiotics = [(s, s * 10 + rnd.randint(0, 1), time()) for s in (subject() for _ in range(60))]
    cultures = [(subject(), time()) for _ in range(60)]
    scores = [(s, s * 10 + rnd.randint(0, 1), time(), rnd.randint(0, 8)) for s in (subject() for _ in range(150))]
    a, c, s = tables(spark, antibiotics, cultures, scores)

    for keys in (("subject_id",), ("subject_id", "icustay_id")):
        by_stay = len(keys) == 2
        windows = onset.infection_windows(a, c, keys)
        expected = {(w[0], w[1] if by_stay else None, w[2], w[3]) for w in brute_windows(antibiotics, cultures)}
        got = [
            (r["subject_id"], r["icustay_id"] if by_stay else None, r["charttime"], r["starttime"])
            for r in windows.collect()
        ]
        assert len(got) == len(set(got)) and set(got) == expected

        summary, first = {}, {}
        for subject_id, stay, h, start in expected:
            inside = sorted(
                (t, st, v) for sid, st, t, v in scores
                if sid == subject_id and (not by_stay or st == stay) and h <= t <= start
            )
            if inside:
                values = [v for _, _, v in inside]
                rise = brute_rise(values)
                summary[(subject_id, stay, h, start)] = (max(values), min(values), rise)
                if rise >= 2:
                    key = (subject_id, stay)
                    first[key] = min(first.get(key, h), h)
        got = {
            (r["subject_id"], r["icustay_id"] if by_stay else None, r["charttime"], r["starttime"]):
            (r["max_score"], r["min_score"], r["rise"])
            for r in onset.score_windows(windows, s, keys).collect()
        }
        assert got == summary
        got = {
            (r["subject_id"], r["icustay_id"] if by_stay else None): r["charttime"]
            for r in onset.onset(windows, s, keys).collect()
        }
        assert got == first


def test_window_edges(spark):
    at = T + 100 * HOUR
    a, c, _ = tables(
        spark, [(1, 1, at)],
        [(1, at - 72 * HOUR), (1, at - 72 * HOUR - timedelta(seconds=1)), (1, at + 24 * HOUR),
         (1, at + 24 * HOUR + timedelta(hours=1)), (2, at)],
        [(1, 1, at, 1)],
    )
    got = sorted(r["charttime"] for r in onset.infection_windows(a, c).collect())
    # the culture one second too early shares no hour with an accepted one
    assert got == [at - 72 * HOUR, at + 24 * HOUR]


@pytest.mark.parametrize("values, expected", [([3, 1, 4, 2, 6], 5), ([6, 4, 2], 0), ([5], 0), ([100, 3], 1)])
def test_max_rise(spark, values, expected):
    df = spark.createDataFrame([(values,)], "v array<int>")
    assert df.select(onset.max_rise(F.col("v"))).first()[0] == expected
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k int, i int, score int")
    assert onset.running_rise(rows, ["k"], ["i"]).agg(F.max("rise")).first()[0] == expected


def test_culture_and_antibiotic_filters(spark):
    cultures = spark.createDataFrame(
        [(1, T, 70011, "x"), (1, None, 70011, "x"), (1, T, 70011, None), (1, T, 1, "x")],
        "subject_id long, charttime timestamp_ntz, spec_itemid int, org_name string",
    )
    assert onset.suspected_cultures(cultures).count() == 1
    inputs = spark.createDataFrame([(1, 5), (2, 5), (1, 6)], "subject_id long, itemid long")
    d_items = spark.createDataFrame([(5, "Antibiotics"), (6, "Other")], "itemid long, category string")
    stays = spark.createDataFrame([(1,), (1,)], "subject_id long")
    assert onset.antibiotic_starts(inputs, d_items).count() == 2
    # a subject with two stays still counts once
    assert onset.antibiotic_starts(inputs, d_items, stays).count() == 1


def test_score_history_matches_brute_force(spark):
    rnd = random.Random(8)
    scores = [
        (s, s, T + timedelta(minutes=10 * rnd.randint(0, 300)), rnd.randint(0, 20))
        for s in (1 if rnd.random() < 0.4 else rnd.randint(2, 5) for _ in range(300))
    ]
    df = spark.createDataFrame(scores, "subject_id long, icustay_id long, starttime timestamp_ntz, score int")
    got = {r["subject_id"]: (r["max_score"], r["min_score"], r["rise"]) for r in onset.score_history(df).collect()}
    for s in range(1, 6):
        values = [v for _, _, v in sorted((t, st, v) for sid, st, t, v in scores if sid == s)]
        assert got[s] == (max(values), min(values), brute_rise(values))
