"""Small cases that once gave wrong answers."""

from __future__ import annotations

import numpy as np
import pytest

from wardline.operators import graph
from wardline.operators.hmm import decode, fit
from wardline.operators.hmm.model import Gaussian, Hmm


def test_variance_of_large_values(spark):
    rows = spark.createDataFrame([(0, 1e9 + x, 1.0) for x in (1.0, 2.0, 3.0, 4.0)], "state int, obs double, w double")
    for weight in (None, "w"):
        got = fit.fit_gaussian(rows, weight).first()
        assert got["mean"] == pytest.approx(1e9 + 2.5, abs=1e-6) and got["variance"] == pytest.approx(1.25)


def test_covariance_of_large_values(spark):
    x = np.array([[1e9 + a, 1e9 + b] for a, b in ((1, 2), (2, 1), (3, 5), (4, 3), (7, 9))])
    rows = spark.createDataFrame([(0, v.tolist()) for v in x], "state int, obs array<double>").repartition(3)
    got = {(r["i"], r["j"]): r["covariance"] for r in fit.fit_multi(rows).collect()}
    want = np.cov((x - 1e9).T, bias=True)
    assert got == pytest.approx({(i, j): want[i, j] for i in range(2) for j in range(i, 2)}, rel=1e-6)


def test_codes_of_different_kinds_differ(spark):
    facts = spark.createDataFrame([(1, 1, "lab", "X"), (2, 1, "medication", "X"), (3, 1, "lab", "X")], "patient_id long, date long, kind string, code string")
    pairs = graph.jaccard_pairs(facts, 0.5).collect()
    assert [(r["patient_a"], r["patient_b"], r["similarity"]) for r in pairs] == [(1, 3, 1.0)]


def test_unreached_patients_have_rank_zero(spark):
    facts = spark.createDataFrame([(1, 1, "a"), (2, 1, "a"), (3, 1, "b")], "patient_id long, date long, code string")
    got = {r["patient_id"]: r["rank"] for r in graph.random_walk(facts, 1, iterations=4).collect()}
    assert got[2] > 0 and got[3] == 0.0
    with pytest.raises(ValueError):
        graph.random_walk(facts, 1, iterations=3)


def test_latest_record_is_whole(spark):
    facts = spark.createDataFrame([(1, 1, "lab", "X", 5.0), (1, 3, "lab", "X", 2.0), (1, 3, "lab", "X", 1.0)], "patient_id long, date long, kind string, code string, value double")
    assert [tuple(r) for r in graph.latest_records(facts).select("date", "value").collect()] == [(3, 2.0)]


def test_far_observation_has_a_certain_state(spark):
    model = Hmm((0.5, 0.5), ((0.5, 0.5), (0.5, 0.5)), (Gaussian(0.0, 1.0), Gaussian(100.0, 1.0)))
    steps = spark.createDataFrame([(1, 0, -50.0)], "seq_id long, t long, obs double")
    got = decode.posterior(steps, model).first()
    assert [got["p0"], got["p1"]] == pytest.approx([1.0, 0.0])
