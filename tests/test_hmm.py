from __future__ import annotations

import math
import random
from itertools import product

import numpy as np
import pytest

from wardline.operators.hmm import decode, fit, train
from wardline.operators.hmm.model import (
    Gaussian,
    Hmm,
    Mixture,
    MultiGaussian,
    Table,
    uniform,
)
from wardline.operators.kmeans import assign, kmeans

TABLE = Hmm((0.6, 0.4), ((0.7, 0.3), (0.4, 0.6)), (Table((0.5, 0.4, 0.1)), Table((0.1, 0.3, 0.6))))
REAL = Hmm((0.6, 0.4), ((0.8, 0.2), (0.3, 0.7)), (Gaussian(30.0, 600.0), Gaussian(80.0, 2500.0)))
THREE = Hmm(
    (0.5, 0.5, 0.0),
    ((0.9, 0.1, 0.0), (0.0, 0.8, 0.2), (0.1, 0.0, 0.9)),
    (Gaussian(0.0, 1.0), Gaussian(3.0, 2.0), Gaussian(-4.0, 0.5)),
)


def steps(spark, sequences, kind="double"):
    rows = [(s, 3 * t + 1, o) for s, seq in sequences.items() for t, o in enumerate(seq)]
    return spark.createDataFrame(rows, f"seq_id long, t long, obs {kind}")


def density(em, x):
    if isinstance(em, Table):
        return em.probabilities[x]
    if isinstance(em, Gaussian):
        return math.exp(-((x - em.mean) ** 2) / (2 * em.variance)) / math.sqrt(2 * math.pi * em.variance)
    if isinstance(em, Mixture):
        return sum(w * density(Gaussian(m, v), x) for w, m, v in zip(em.weights, em.means, em.variances))
    d = np.array(x) - np.array(em.mean)
    c = np.array(em.covariance)
    return float(np.exp(-0.5 * d @ np.linalg.inv(c) @ d) / np.sqrt((2 * np.pi) ** len(d) * np.linalg.det(c)))


def plain(model, seq):
    """Unscaled forward-backward in numpy: likelihood, posteriors and expected moves."""
    a, pi = np.array(model.transitions), np.array(model.initial)
    b = np.array([[density(em, x) for em in model.emissions] for x in seq])
    alpha = [pi * b[0]]
    for t in range(1, len(seq)):
        alpha.append(alpha[-1] @ a * b[t])
    beta = [np.ones(model.k)]
    for t in range(len(seq) - 1, 0, -1):
        beta.insert(0, a @ (b[t] * beta[0]))
    p = alpha[-1].sum()
    gamma = np.array(alpha) * np.array(beta) / p
    xi = sum(
        (np.outer(alpha[t], b[t + 1] * beta[t + 1]) * a / p for t in range(len(seq) - 1)),
        np.zeros_like(a),
    )
    return p, gamma, xi


def random_sequences(seed, n=5, longest=40, values=None):
    rnd = random.Random(seed)
    draw = (lambda: rnd.choice(values)) if values else (lambda: rnd.gauss(40, 30))
    return {s: [draw() for _ in range(rnd.randint(1, longest))] for s in range(n)}


def test_three_steps_by_hand(spark):
    seq = [0, 2, 1]
    by_path = {}
    for path in product(range(2), repeat=3):
        p = TABLE.initial[path[0]] * TABLE.emissions[path[0]].probabilities[seq[0]]
        for t in (1, 2):
            p *= TABLE.transitions[path[t - 1]][path[t]] * TABLE.emissions[path[t]].probabilities[seq[t]]
        by_path[path] = p
    df = steps(spark, {1: seq}, "int")
    assert decode.probabilities(df, TABLE).first()["probability"] == pytest.approx(sum(by_path.values()))
    best = max(by_path, key=by_path.get)
    got = decode.viterbi(df, TABLE).orderBy("t").collect()
    assert tuple(r["state"] for r in got) == best
    assert got[0]["path_log_probability"] == pytest.approx(math.log(by_path[best]))
    for path, p in by_path.items():
        rows = [(1, t, o, s) for t, (o, s) in enumerate(zip(seq, path))]
        given = spark.createDataFrame(rows, "seq_id long, t long, obs int, state int")
        assert decode.path_log_probability(given, TABLE, 2).first()["log_probability"] == pytest.approx(math.log(p))


@pytest.mark.parametrize("model", [REAL, THREE], ids=["two", "three"])
@pytest.mark.parametrize("chunk", [3, 20, 1000])
def test_scores_match_the_plain_recursion_for_any_chunk_size(spark, model, chunk):
    sequences = random_sequences(3)
    if model is THREE:
        sequences = {s: [(x - 40) / 10 for x in seq] for s, seq in sequences.items()}
    df = steps(spark, sequences)
    expected = {s: plain(model, seq) for s, seq in sequences.items()}
    for r in decode.log_likelihoods(df, model, chunk).collect():
        assert r["log_likelihood"] == pytest.approx(math.log(expected[r["seq_id"]][0]), abs=1e-8)
        assert r["n_steps"] == len(sequences[r["seq_id"]])
    rows = decode.posterior(df, model, chunk).collect()
    assert len(rows) == sum(map(len, sequences.values()))
    for r in rows:
        want = expected[r["seq_id"]][1][(r["t"] - 1) // 3]
        assert [r[f"p{i}"] for i in range(model.k)] == pytest.approx(list(want), abs=1e-8)


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_best_paths_match_a_plain_search_and_ties_keep_the_lower_state(spark, chunk):
    even = Hmm((0.5, 0.5), ((0.5, 0.5), (0.5, 0.5)), (Table((0.5, 0.5)), Table((0.5, 0.5))))
    got = decode.viterbi(steps(spark, {1: [0, 1, 0, 1, 1]}, "int"), even, chunk).collect()
    assert {r["state"] for r in got} == {0} and len(got) == 5

    sequences = random_sequences(11, n=4, longest=9)
    got = {}
    for r in decode.viterbi(steps(spark, sequences), REAL, chunk).orderBy("t").collect():
        got.setdefault(r["seq_id"], []).append(r["state"])
    for s, seq in sequences.items():
        def score(path):
            p = math.log(REAL.initial[path[0]])
            for t, state in enumerate(path):
                p += math.log(density(REAL.emissions[state], seq[t]))
                if t:
                    p += math.log(REAL.transitions[path[t - 1]][state])
            return p

        best = max(score(p) for p in product(range(2), repeat=len(seq)))
        assert score(got[s]) == pytest.approx(best)


def test_long_sequence_neither_underflows_nor_depends_on_chunks(spark):
    """One sequence holds nearly all steps."""
    rnd = random.Random(5)
    long = [rnd.gauss(40, 30) for _ in range(3000)]
    df = steps(spark, {1: long, 2: long[:3]})
    one = {r["seq_id"]: r["log_likelihood"] for r in decode.log_likelihoods(df, REAL, 30_000).collect()}
    many = {r["seq_id"]: r["log_likelihood"] for r in decode.log_likelihoods(df, REAL, 100).collect()}
    assert math.isfinite(many[1]) and many == pytest.approx(one, rel=1e-10)


def test_impossible_observations_stay_finite(spark):
    strict = Hmm((1.0, 0.0), ((0.5, 0.5), (0.0, 1.0)), (Table((1.0, 0.0)), Table((0.0, 1.0))))
    df = steps(spark, {1: [0, 0, 1, 1], 2: [1, 0, 1, 0]}, "int")
    got = {r["seq_id"]: r["log_likelihood"] for r in decode.log_likelihoods(df, strict, 2).collect()}
    assert got[1] == pytest.approx(2 * math.log(0.5)) and got[2] < -500
    assert all(0 <= r["p0"] <= 1 for r in decode.posterior(df, strict, 2).collect())
    path = [r["state"] for r in decode.viterbi(df, strict, 2).where("seq_id = 1").orderBy("t").collect()]
    assert path == [0, 0, 1, 1]


def plain_improve(model, sequences):
    parts = {s: plain(model, seq) for s, seq in sequences.items()}
    xi = sum(p[2] for p in parts.values())
    initial = np.mean([p[1][0] for p in parts.values()], axis=0)
    x = [o for seq in sequences.values() for o in seq]
    g = np.concatenate([p[1] for p in parts.values()])
    return initial, xi / xi.sum(axis=1, keepdims=True), x, g


@pytest.mark.parametrize("chunk", [5, 1000])
def test_one_round_of_training(spark, chunk):
    sequences = random_sequences(2, n=6)
    model = train.baum_welch(steps(spark, sequences), REAL, 1, chunk)
    initial, moves, x, g = plain_improve(REAL, sequences)
    assert model.initial == pytest.approx(tuple(initial))
    assert np.array(model.transitions) == pytest.approx(moves)
    x = np.array(x)
    for i, em in enumerate(model.emissions):
        w = g[:, i] / g[:, i].sum()
        mean = (w * x).sum()
        assert em.mean == pytest.approx(mean) and em.variance == pytest.approx((w * (x - mean) ** 2).sum())


def test_table_training_raises_the_likelihood(spark):
    df = steps(spark, random_sequences(4, n=8, values=[0, 1, 2]), "int")

    def likelihood(m):
        return sum(r["log_likelihood"] for r in decode.log_likelihoods(df, m).collect())

    trained = train.baum_welch(df, TABLE, 4, 7)
    assert likelihood(trained) > likelihood(TABLE)
    assert sum(trained.emissions[0].probabilities) == pytest.approx(1.0)


def test_unreachable_state_keeps_its_row(spark):
    model = Hmm((1.0, 0.0), ((1.0, 0.0), (0.25, 0.75)), (Gaussian(0.0, 1.0), Gaussian(5.0, 1.0)))
    trained = train.baum_welch(steps(spark, {1: [0.1, -0.2, 0.3]}), model, 1)
    assert trained.transitions[1] == pytest.approx((0.25, 0.75))
    assert trained.emissions[1] == Gaussian(5.0, 1.0)


def test_vector_model(spark):
    rnd = np.random.default_rng(1)
    sequences = {s: [list(map(float, rnd.normal(s % 2 * 4, 1, 2))) for _ in range(12)] for s in range(4)}
    df = steps(spark, sequences, "array<double>")
    full = MultiGaussian((0.0, 0.0), ((1.0, 0.3), (0.3, 1.0)))
    other = MultiGaussian((4.0, 4.0), ((2.0, 0.0), (0.0, 1.0)))
    model = Hmm((0.5, 0.5), ((0.9, 0.1), (0.2, 0.8)), (full, other))
    for r in decode.log_likelihoods(df, model, 5).collect():
        assert r["log_likelihood"] == pytest.approx(math.log(plain(model, sequences[r["seq_id"]])[0]), abs=1e-8)
    trained = train.baum_welch(df, model, 1, 5)
    _, _, x, g = plain_improve(model, sequences)
    x, w = np.array(x), g[:, 0] / g[:, 0].sum()
    mean = w @ x
    assert np.array(trained.emissions[0].mean) == pytest.approx(mean)
    assert np.array(trained.emissions[0].covariance) == pytest.approx((x - mean).T @ ((x - mean) * w[:, None]))
    start = train.vector_start(df, 2)
    fitted = train.baum_welch(df, start, 3)
    assert all(em.covariance[0][1] == 0.0 for em in fitted.emissions)


def test_mixture_step_uses_old_means(spark):
    mixture = Mixture((0.6, 0.4), (30.0, 90.0), (500.0, 2500.0))
    rnd = random.Random(3)
    x = [rnd.gauss(50, 30) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in x], "obs double")
    got = {r["component"]: r for r in fit.fit_mixture_step(df, mixture).collect()}
    parts = [[w * density(Gaussian(m, v), o) for w, m, v in zip(mixture.weights, mixture.means, mixture.variances)] for o in x]
    r = np.array(parts) / np.array(parts).sum(axis=1, keepdims=True)
    for c in range(2):
        assert got[c]["weight"] == pytest.approx(r[:, c].sum() / r.sum())
        assert got[c]["mean"] == pytest.approx((r[:, c] @ np.array(x)) / r[:, c].sum())
        assert got[c]["variance"] == pytest.approx((r[:, c] @ (np.array(x) - mixture.means[c]) ** 2) / r[:, c].sum())


def test_counts_across_chunks(spark):
    rows = [(s, t, (t * (s + 1)) % 3) for s in range(3) for t in range(25)]
    df = spark.createDataFrame(rows, "seq_id long, t long, state int")
    expected = {}
    for s in range(3):
        for t in range(24):
            pair = ((t * (s + 1)) % 3, ((t + 1) * (s + 1)) % 3)
            expected[pair] = expected.get(pair, 0) + 1
    for chunk in (1, 4, 100):
        got = {(r["state"], r["next_state"]): r["n"] for r in fit.transition_counts(df, chunk).collect()}
        assert got == expected
    assert {r["state"]: r["n"] for r in fit.initial_states(df).collect()} == {0: 3}


def test_learning_from_labels_and_by_clusters(spark):
    rnd = random.Random(9)
    sequences, labelled = {}, []
    for s in range(6):
        state, seq = 0, []
        for t in range(40):
            state = state if rnd.random() < 0.9 else 1 - state
            o = rnd.gauss(10 if state else -10, 1)
            seq.append(o)
            labelled.append((s, 3 * t + 1, o, state))
        sequences[s] = seq
    rows = spark.createDataFrame(labelled, "seq_id long, t long, obs double, state int")
    for chunk in (7, 1000):
        model = train.learn_labelled(rows, [Gaussian(0.0, 1.0)] * 2, chunk)
        moves = np.zeros((2, 2))
        for s in range(6):
            states = [r[3] for r in labelled if r[0] == s]
            for a, b in zip(states, states[1:]):
                moves[a, b] += 1
        assert np.array(model.transitions) == pytest.approx(moves / moves.sum(axis=1, keepdims=True))
        xs = [r[2] for r in labelled if r[3] == 1]
        assert model.emissions[1].mean == pytest.approx(np.mean(xs))
        assert model.emissions[1].variance == pytest.approx(np.var(xs))
    # the clusters are far apart, so clustering finds the same model, up to state order
    found = train.kmeans_learn(steps(spark, sequences), Gaussian(0.0, 1.0), 2, chunk_steps=16)
    assert sorted(em.mean for em in found.emissions) == pytest.approx(sorted(em.mean for em in model.emissions))


def test_never_seen_state_falls_back_to_its_prototype(spark):
    rows = spark.createDataFrame([(1, 0, 1.0, 0), (1, 1, 3.0, 0)], "seq_id long, t long, obs double, state int")
    model = train.learn_labelled(rows, [Gaussian(0.0, 1.0), Gaussian(7.0, 2.0)])
    assert model.emissions[1] == Gaussian(7.0, 2.0)
    assert model.transitions == ((1.0, 0.0), (0.5, 0.5))
    assert model.initial == (1.0, 0.0)


def test_model_gap_is_zero_for_the_same_model(spark):
    df = steps(spark, random_sequences(1))
    assert decode.model_gap(df, REAL, REAL).first()["gap"] == pytest.approx(0.0)


def test_posterior_mass_sums_to_the_number_of_steps(spark):
    sequences = random_sequences(6)
    mass = decode.posterior_mass(steps(spark, sequences), REAL, 8).collect()
    assert sum(r["mass"] for r in mass) == pytest.approx(sum(map(len, sequences.values())))


def test_kmeans_starts_from_the_first_distinct_points(spark):
    rnd = np.random.default_rng(4)
    x = np.concatenate([[[0.0, 0.0]] * 3, rnd.normal(0, 1, (40, 2)), rnd.normal(6, 1, (40, 2))])
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id long, x array<double>")
    centres = np.array([x[0], x[3], x[4]])
    while True:
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(3)])
        if np.allclose(moved, centres, atol=1e-12):
            break
        centres = moved
    got = kmeans(df, "x", ["id"], 3)
    assert np.array(got) == pytest.approx(centres)
    clusters = {r["id"]: r["cluster"] for r in assign(df, "x", got).collect()}
    assert [clusters[i] for i in range(len(x))] == list(near)


def test_multivariate_fit(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(0, 1, (60, 3))
    df = spark.createDataFrame([(i % 2, list(map(float, v))) for i, v in enumerate(x)], "state int, obs array<double>")
    for r in fit.fit_multi(df.repartition(3)).collect():
        part = x[r["state"] :: 2]
        assert r["covariance"] == pytest.approx(np.cov(part.T, bias=True)[r["i"], r["j"]])
        assert r["mean_i"] == pytest.approx(part.mean(0)[r["i"]])


def test_uniform_start(spark):
    assert uniform([Gaussian(0, 1)] * 4).transitions[2] == (0.25,) * 4


def test_fits_are_not_cut_short(spark, monkeypatch):
    from wardline.plans import queries
    from wardline.plans.bindings import Ward

    rng = np.random.default_rng(2)
    df = steps(spark, {s: (rng.normal(0, 1, 40) + s % 2).tolist() for s in range(4)})
    with pytest.raises(RuntimeError, match="1 rounds"):
        train.kmeans_learn(df, Gaussian(0.0, 1.0), 2, max_iterations=1)
    asked = {}
    monkeypatch.setattr(train, "baum_welch", lambda steps, model, iterations: asked.update(rounds=iterations) or model)
    monkeypatch.setattr(train, "kmeans_learn", lambda steps, model, k, max_iterations=None: asked.update(bound=max_iterations) or REAL)
    queries._vector_hmm_predict(Ward(spark, "/root/testdata/sf0.001"))
    queries._hmm_kmeans(Ward(spark, "/root/testdata/sf0.001"))
    assert asked == {"rounds": 50, "bound": None}


@pytest.mark.parametrize("fan", [2, 5])
def test_trees_of_any_depth_equal_the_plain_recursion(spark, monkeypatch, fan):
    """One sequence of many chunks beside short ones: several levels of nodes, with gaps between steps."""
    from wardline.operators.hmm import chunks

    monkeypatch.setattr(chunks, "FAN", fan)
    monkeypatch.setattr(decode, "FAN", fan)
    rnd = random.Random(8)
    sequences = {1: [rnd.gauss(40, 30) for _ in range(90)], 2: [10.0], 3: [rnd.gauss(60, 40) for _ in range(17)]}
    df = steps(spark, sequences)
    assert chunks.chunked(df, 4).levels > 2 if fan == 2 else chunks.chunked(df, 4).levels >= 1
    expected = {s: plain(REAL, seq) for s, seq in sequences.items()}
    for r in decode.log_likelihoods(df, REAL, 4).collect():
        assert r["log_likelihood"] == pytest.approx(math.log(expected[r["seq_id"]][0]), abs=1e-8)
        assert r["n_steps"] == len(sequences[r["seq_id"]])
    rows = decode.posterior(df, REAL, 4).collect()
    assert len(rows) == 108
    for r in rows:
        assert [r["p0"], r["p1"]] == pytest.approx(list(expected[r["seq_id"]][1][(r["t"] - 1) // 3]), abs=1e-8)
    trained = train.baum_welch(df, REAL, 1, 4)
    whole = train.baum_welch(df, REAL, 1, 100_000)
    assert np.array(trained.transitions) == pytest.approx(np.array(whole.transitions), abs=1e-10)
    assert [r for r in decode.viterbi(df, REAL, 4).orderBy("seq_id", "t").collect()] == [
        pytest.approx(r) for r in decode.viterbi(df, REAL, 100_000).orderBy("seq_id", "t").collect()
    ]


def test_rounds_over_chunks_that_lie_together_move_no_chunk(spark, monkeypatch):
    """Short sequences, though all of them span more than a node; the results are the tree's."""
    from dataclasses import replace

    from wardline.operators.hmm import chunks

    for module in (chunks, decode):
        monkeypatch.setattr(module, "FAN", 16)
    rnd = random.Random(3)
    rows = [(s, 50 * s + t, rnd.gauss(40, 30)) for s in range(1, 6) for t in range(5 + 5 * s)]
    cut = chunks.chunked(spark.createDataFrame(rows, "seq_id long, t long, obs double"), 4)
    assert cut.together and cut.levels > 0
    for ready in (chunks.with_ends(cut, chunks.numbers(REAL)), decode.decoded(cut, REAL)):
        plan = ready._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    tree = replace(cut, rows=cut.rows.cache(), together=False)
    start = train.uniform([Gaussian(40.0, 900.0)] * 2)
    for round_of in (lambda c: train.improve(c, REAL), lambda c: train._relearn(c, REAL, start)):
        assert train._numbers(round_of(cut)) == pytest.approx(train._numbers(round_of(tree)))
    tree.unpersist()


def test_a_round_over_kept_runs_is_one_job(spark):
    """It starts no query; kept or not, and with labels met in the task or in a window, models are the same."""
    from dataclasses import replace

    from wardline.operators.hmm import chunks

    rnd = random.Random(9)
    rows = [(s, 40 * s + t, rnd.gauss(40, 30), rnd.randrange(2)) for s in range(1, 6) for t in range(5 + 5 * s)]
    cut = chunks.chunked(spark.createDataFrame(rows, "seq_id long, t long, obs double, state int"), 4, also=["state"])
    start, kept = train.uniform([Gaussian(40.0, 900.0)] * 2), cut.persist()
    rounds = [lambda c: train.improve(c, REAL), lambda c: train._relearn(c, REAL, start), lambda c: train._learn_given(c, start)]
    assert kept.steps == len(rows) and kept.runs.getNumPartitions() <= max(4, spark.sparkContext.defaultParallelism)
    many = replace(cut, rows=cut.rows.repartition(300, "seq_id").sortWithinPartitions("seq_id", "chunk")).persist()
    assert many.runs.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert train._numbers(train.improve(many, REAL)) == pytest.approx(train._numbers(train.improve(cut, REAL)))
    many.unpersist()
    for i, round_of in enumerate(rounds):
        want = train._numbers(round_of(cut))
        spark.sparkContext.setJobGroup(f"round {i}", "")
        assert train._numbers(round_of(kept)) == pytest.approx(want)
        round_of(kept)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"round {i}")
        assert len(jobs) == 2
    kept.unpersist()
    tree = replace(cut, rows=cut.rows.cache(), together=False)
    assert train._numbers(train._learn_given(tree, start)) == pytest.approx(want)
    tree.unpersist()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_missing_observation_says_nothing(spark):
    df = spark.createDataFrame([(1, 0, 20.0), (1, 1, None), (1, 2, 90.0)], "seq_id long, t long, obs double")
    a, pi = np.array(REAL.transitions), np.array(REAL.initial)
    b = np.array([[density(em, x) for em in REAL.emissions] for x in (20.0, 90.0)])
    want = (((pi * b[0]) @ a) @ a * b[1]).sum()
    assert decode.probabilities(df, REAL).first()["probability"] == pytest.approx(want)
    trained = train.baum_welch(df, REAL, 1)
    assert all(math.isfinite(em.mean) and em.variance > 0 for em in trained.emissions)


def test_mixture_densities_have_no_floor():
    mixture = Mixture((0.6, 0.4), (0.0, 5.0), (1.0, 0.5))
    x = np.array([0.3, 4.0, 400.0])
    assert mixture.log_densities(x)[:2] == pytest.approx([math.log(density(mixture, v)) for v in x[:2]])
    assert mixture.log_densities(x)[2] < -70_000
    w = np.array([1.0, 2.0, 0.5])
    assert np.isfinite(mixture.weighted_terms(x, w)).all() and mixture.weighted_terms(x, w)[0::3].sum() == pytest.approx(3.5)


def test_a_very_long_sequence_is_bounded_in_every_task(spark):
    """One sequence of 3 million steps: two levels of nodes, and no row above FAN children or one chunk."""
    from wardline.operators.hmm import chunks

    df = spark.range(3_000_000).selectExpr("1L AS seq_id", "id AS t", "CAST(id % 97 AS DOUBLE) AS obs")
    cut = chunks.chunked(df)
    assert cut.levels == 2
    n = chunks.numbers(REAL)
    levels = chunks.matrix_levels(cut, n)
    assert [level.count() for level in levels] == [23_438, 184, 2]
    short = decode.log_likelihoods(df.where("t < 97000"), REAL).first()["log_likelihood"]
    whole = decode.log_likelihoods(df, REAL).first()["log_likelihood"]
    assert whole / 3_000_000 == pytest.approx(short / 97_000, rel=1e-3)


def test_unseen_sequences_are_scored_by_the_fit_of_the_others(spark):
    sequences = random_sequences(7, n=6)
    df = steps(spark, sequences)
    split = spark.createDataFrame([(s, "train" if s < 4 else "test") for s in sequences], "seq_id long, part string")
    table, scores = train.held_out(df, split, iterations=2)
    seen = df.where("seq_id < 4")
    model = train.baum_welch(seen, train.gaussian_start(seen), 2)
    assert train._numbers(train.gaussian_model(table)) == pytest.approx(train._numbers(model))
    got = {r["seq_id"]: r for r in scores.collect()}
    assert sorted(got) == [4, 5]
    for s, r in got.items():
        assert r["log_likelihood"] == pytest.approx(math.log(plain(model, sequences[s])[0])) and r["n_steps"] == len(sequences[s])
        assert r["per_step"] == pytest.approx(r["log_likelihood"] / r["n_steps"])
