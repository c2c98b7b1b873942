from __future__ import annotations

import math
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardline.operators import classify, cohorts, sampling, summary
from wardline.operators.ranking import row_index

T = datetime(2020, 1, 1)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "subject_id long")


def test_overlap_shares_of_the_union(spark):
    got = cohorts.cohort_overlap({"a": ids(spark, 1, 2, 2, 3), "b": ids(spark, 3, 4), "c": ids(spark)}).collect()
    shares = {(r["left_cohort"], r["right_cohort"]): (r["both_share"], r["left_share"], r["right_share"]) for r in got}
    assert shares[("a", "b")] == pytest.approx((0.25, 0.5, 0.25))
    assert shares[("a", "c")] == pytest.approx((0.0, 1.0, 0.0))
    empty = cohorts.cohort_overlap({"a": ids(spark), "b": ids(spark)}).first()
    assert empty["both_share"] is None


def test_common_and_missing_subjects(spark):
    a, b, c = ids(spark, 1, 2, 3), ids(spark, 2, 2, 3), ids(spark, 3, 2, 9)
    assert sorted(r[0] for r in cohorts.common_subjects(a, b, c).collect()) == [2, 3]
    assert [t.count() for t in cohorts.keep_common(a, b, c)] == [2, 3, 2]
    assert [r[0] for r in cohorts.non_septic(a, ids(spark, 1, 3)).collect()] == [2]


def test_stay_summaries(spark):
    rows = [(1, T + timedelta(hours=h), int(h == 2), float(h)) for h in range(3)] + [(2, T, 1, 9.0)]
    m = spark.createDataFrame(rows, "icustay_id long, charttime timestamp_ntz, label int, x double")
    assert {r[0]: r[1] for r in cohorts.stay_labels(m).collect()} == {1: 1, 2: 1}
    assert {r[0]: r[1] for r in cohorts.stay_lengths(m, 2).collect()} == {1: 3}
    got = {r["icustay_id"]: (r["sequence"], r["length"]) for r in cohorts.stay_sequences(m, ["x"]).collect()}
    assert got == {1: ([[0.0], [1.0], [2.0]], 3), 2: ([[9.0]], 1)}


def test_sequences_of_the_wrong_shape_are_dropped(spark):
    rows = [(1, t, [0.0] * 8) for t in range(7)] + [(2, t, [0.0] * 8) for t in range(6)]
    rows += [(3, t, [0.0] * (8 if t else 7)) for t in range(9)]
    steps = spark.createDataFrame(rows, "seq_id long, t int, obs array<double>")
    assert {r["seq_id"] for r in cohorts.long_sequences(steps, "obs").collect()} == {1}


def test_row_index_of_a_group_with_a_third_of_the_rows(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("g"),
        (F.col("id") * 7919 % 3000).alias("v"),
    )
    got = row_index(df, ["g"], F.floor(F.col("v") / 100), ["v"]).where("g = 0").orderBy("v").collect()
    assert [r["idx"] for r in got] == list(range(1000))


def test_sampling_repeats_and_keeps_the_rate(spark):
    stays = spark.range(4000).select(
        (F.col("id") % 2000).alias("subject_id"), F.col("id").alias("icustay_id")
    )
    one = {r[0] for r in sampling.sample_patients(stays, 0.25).collect()}
    two = {r[0] for r in sampling.sample_patients(stays.repartition(7), 0.25).collect()}
    assert one == two and abs(len(one) - 500) < 80
    assert sampling.sample_patients(stays, 0.0).count() == 0 and sampling.sample_patients(stays, 1.0).count() == 2000
    assert {r[0] for r in sampling.sample_patients(stays, 0.25, seed=1).collect()} != one


def test_strata(spark):
    stays = spark.range(4000).select((F.col("id") % 2000).alias("subject_id"), F.col("id").alias("icustay_id"))
    labels = spark.range(200).select(F.col("id").alias("subject_id"))
    got = sampling.sample_strata(stays, labels, 0.25).collect()
    septic = [r["subject_id"] for r in got if r["septic"]]
    others = [r["subject_id"] for r in got if not r["septic"]]
    assert len(set(septic)) == len(septic) and all(s < 200 for s in septic) and all(o >= 200 for o in others)
    # others are drawn per stay, at (n * p - septic) / n with n their stays
    rate = (3600 * 0.25 - len(septic)) / 3600
    expected = 1800 * (1 - (1 - rate) ** 2)
    assert abs(len(others) - expected) < 5 * math.sqrt(expected)
    # a sample that is already too large leaves no room: the rate stays at zero
    few = stays.where("subject_id < 201")
    assert all(r["septic"] for r in sampling.sample_strata(few, labels, 0.25).collect())
    counts = {r["stratum"]: r["n"] for r in sampling.stratum_counts(stays, labels).collect()}
    assert counts == {"septic": 200, "non_septic": 3600}
    kept = sampling.keep_subjects(stays, labels)
    assert kept.count() == 400


def test_split_is_exact_per_file(spark):
    sequences = spark.range(1000).select(
        F.when(F.col("id") < 700, F.lit(0)).otherwise(F.col("id") % 5 + 1).alias("file"), F.col("id").alias("key")
    )
    rows = sampling.split_sequences(sequences, "file", "key").collect()
    sizes = Counter(r["file"] for r in rows)
    trained = Counter(r["file"] for r in rows if r["part"] == "train")
    assert trained == {f: round(n * 0.75) for f, n in sizes.items()} and len(rows) == 1000


def test_counts(spark):
    events = spark.createDataFrame([(1, 5, "x"), (1, 5, "x"), (2, 5, None), (2, 6, "x"), (3, 7, "x")],
                                   "subject_id long, itemid long, flag string")
    d_items = spark.createDataFrame([(5, "five"), (6, "six")], "itemid long, label string")
    got = {r["itemid"]: (r["label"], r["n"]) for r in summary.item_counts(events, d_items).collect()}
    assert got == {5: ("five", 3), 6: ("six", 1)}
    assert summary.item_counts(events, d_items, "subject_id", "flag").count() == 3
    drugs = spark.createDataFrame([("vancomycin",), ("vancomycin",), ("aspirin",)], "drug string")
    assert [tuple(r) for r in summary.value_counts(drugs, "drug", "mycin").collect()] == [("vancomycin", 2)]
    assert summary.matching(d_items, "label", "iv").count() == 1
    top = summary.top_rows(events, [F.desc("itemid"), "subject_id"], 2).collect()
    assert [r["itemid"] for r in top] == [7, 6]


def test_code_ranges_are_open_and_cross_blocks(spark):
    codes = [(1, 10), (1, 11), (1, 19), (1, 20), (1, 1500), (2, 1500), (2, 1500), (2, 2500)]
    ranges = [(10, 20, "a"), (900, 2600, "b"), (15, 15, "none"), (30, 5, "none")]
    got = summary.code_range_counts(
        spark.createDataFrame(codes, "subject_id long, code long"),
        spark.createDataFrame(ranges, "low long, high long, section string"),
    ).collect()
    assert {(r["subject_id"], r["code"], r["section"]): r["n"] for r in got} == {
        (1, 11, "a"): 1, (1, 19, "a"): 1, (1, 1500, "b"): 1, (2, 1500, "b"): 2, (2, 2500, "b"): 1
    }


def test_classifiers_separate_the_labels(spark):
    rows = [
        (i, T + timedelta(hours=i), int(i % 4 == 0), *[float(i % 7) for _ in range(7)], 90 if i % 4 == 0 else 30)
        for i in range(200)
    ]
    columns = ", ".join(f"{c} double" for c in classify.FEATURES[:-1])
    m = spark.createDataFrame(rows, f"icustay_id long, charttime timestamp_ntz, label int, {columns}, age int")
    model = classify.fit_elastic_net(m)
    assert model.getThreshold() == 0.1 and model.getMaxIter() == 10 and not model.getStandardization()
    table = {r["feature"]: r["coefficient"] for r in classify.coefficients(model, m).collect()}
    assert set(table) == {"intercept", *classify.FEATURES} and table["age"] > 0
    p = classify.sgd_probabilities(m, ["icustay_id"]).collect()
    assert len(p) == 200 and all(r["p0"] + r["p1"] == pytest.approx(1.0) for r in p)


def plain_descent(rows, w, seen, alpha=1e-4, mix=0.15):
    """One pass written out step by step."""
    import math

    offset = 1 / (alpha * math.sqrt(1 / math.sqrt(alpha)))
    for t, (label, *x) in enumerate(rows, seen):
        eta = 1 / (alpha * (offset + t))
        p = 1 / (1 + math.exp(-max(-700, min(700, sum(a * b for a, b in zip(w, x)) + w[-1]))))
        for i, v in enumerate(x):
            moved = w[i] * (1 - eta * alpha * (1 - mix)) + eta * (label - p) * v
            w[i] = math.copysign(max(abs(moved) - eta * alpha * mix, 0.0), moved)
        w[-1] += eta * (label - p)
    return w


def test_stochastic_passes_equal_the_steps_written_out(spark):
    rnd = __import__("random").Random(6)
    rows = [(i, i % 3 == 0, rnd.gauss(1.0 if i % 3 == 0 else -1.0, 1.0), rnd.gauss(0, 1)) for i in range(300)]
    m = spark.createDataFrame([(i, int(label), a, b) for i, label, a, b in rows], "id long, label int, a double, b double")
    order = [r["id"] for r in m.selectExpr("id", "xxhash64(id) AS h").orderBy("h").collect()]
    by_id = {r[0]: r[1:] for r in rows}
    w = [0.0] * 3
    for p in range(2):
        w = plain_descent([by_id[i] for i in order], w, 300 * p)
    for parts in (1, 5):
        assert classify.fit_sgd(m.repartition(parts), ["id"], ["a", "b"]) == pytest.approx(w)
    assert w[0] > 0.1
    # several shards: passes from the same weights, averaged by their rows
    shards = {r["id"]: r["s"] for r in m.selectExpr("id", "pmod(shiftright(xxhash64(id), 8), 4) AS s").collect()}
    average, seen = [0.0] * 3, 0
    for _ in range(2):
        parts = [[by_id[i] for i in order if shards[i] == s] for s in range(4)]
        made = [(len(part), plain_descent(part, list(average), seen)) for part in parts]
        average = [sum(n * v[k] for n, v in made) / 300 for k in range(3)]
        seen += max(len(part) for part in parts)
    assert classify.fit_sgd(m.repartition(7), ["id"], ["a", "b"], shard_rows=75) == pytest.approx(average)
    assert classify.fit_sgd(m.limit(0), ["id"], ["a", "b"]) == [0.0] * 3


def test_counts_of_many_groups_are_shared_by_more_tasks(spark, monkeypatch):
    """Tasks grow with the groups; repeated labels, missing keys and unlisted items count as before."""
    rows = [(i % 40 if i % 41 else None, i % 3, "AN"[i % 2]) for i in range(400)]
    events = spark.createDataFrame(rows, "subject_id long, itemid long, flag string")
    names = spark.createDataFrame([(0, "a"), (0, "a"), (1, None), (None, "b")], "itemid long, label string")
    want = {}
    for subject, item, flag in rows:
        if item in (0, 1):
            key = (item, subject, flag, "a" if item == 0 else None)
            want[key] = want.get(key, 0) + (2 if item == 0 else 1)
    for tasks_groups in (500_000, 10):
        monkeypatch.setattr(summary, "GROUPS_OF_TASK", tasks_groups)
        counts = summary.item_counts(events, names, "subject_id", "flag")
        assert {tuple(r)[:4]: r["n"] for r in counts.collect()} == want
    assert counts.columns == ["itemid", "subject_id", "flag", "label", "n"]
    monkeypatch.setattr(summary, "GROUPS_OF_TASK", 10)
    assert "REPARTITION_BY_NUM" in summary.item_counts(events, names, "subject_id", "flag")._jdf.queryExecution().executedPlan().toString()


def test_stochastic_scores_run_what_is_behind_the_matrix_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = [(i, float(i % 2), *[float(i % 7 + j) for j in range(len(classify.FEATURES))]) for i in range(60)]
    plain = spark.createDataFrame(rows, ["id", "label", *classify.FEATURES])
    got = {r["id"]: r["p1"] for r in classify.sgd_probabilities(plain.withColumn("label", counted("label")), ["id"]).collect()}
    assert seen.value == 60
    assert got == pytest.approx({r["id"]: r["p1"] for r in classify.sgd_probabilities(plain, ["id"]).collect()})
