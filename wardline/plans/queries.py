"""Named queries: each reads the given tables through :class:`Ward` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import items
from wardline.functions.arrays import (
    euclidean,
    vector_add,
    vector_scale,
    vector_subtract,
)
from wardline.functions.clock import hour_number
from wardline.operators import (
    classify,
    cohorts,
    features,
    graph,
    grid,
    kmeans,
    onset,
    ranking,
    sampling,
    summary,
)
from wardline.operators.hmm import decode, fit, train
from wardline.operators.hmm.model import Gaussian, Hmm, Mixture, Table
from wardline.operators.stays import stay_bounds
from wardline.plans.bindings import Ward
from wardline.session import cut_lineage
from wardline.sources import rows, text

Query = Callable[[Ward], DataFrame]

REAL_MODEL = Hmm((0.6, 0.4), ((0.8, 0.2), (0.3, 0.7)), (Gaussian(30.0, 600.0), Gaussian(80.0, 2500.0)))
OTHER_MODEL = Hmm((0.5, 0.5), ((0.9, 0.1), (0.1, 0.9)), (Gaussian(45.0, 900.0), Gaussian(60.0, 3600.0)))
TABLE_MODEL = Hmm(
    (0.7, 0.3),
    ((0.75, 0.25), (0.4, 0.6)),
    (Table((0.3, 0.25, 0.2, 0.15, 0.1)), Table((0.1, 0.1, 0.2, 0.25, 0.35))),
)
MIXTURE = Mixture((0.6, 0.4), (30.0, 90.0), (500.0, 2500.0))
SIMILAR = 0.05
SAMPLE_RATE = 0.3
WALK_STEPS = 50
VECTOR_ROUNDS = 50
SEQUENCE_COLUMNS = ("bp_dia", "bp_sys", "heart_rate", "resp_rate", "temp_f", "spo2", "gcs", "age")


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def _ladder(ladder: Sequence[int], with_item: bool = True) -> Query:
    def run(w: Ward) -> DataFrame:
        return rounded(features.feature_table(w.chart, w.adults, ladder, "value", with_item, w.d_items), "value")

    return run


def _family(ids: Sequence[int], adults_only: bool = True) -> Query:
    def run(w: Ward) -> DataFrame:
        known = features.known_items(w.chart, w.d_items, ids)
        stays = w.adults if adults_only else w.stays
        return rounded(features.item_hourly_mean(known, stays, ids), "avg_value")

    return run


def _wide(w: Ward) -> DataFrame:
    return rounded(w.features, *items.VITALS).orderBy("subject_id", "charttime")


def _raw_mean(w: Ward) -> DataFrame:
    return rounded(
        features.item_raw_mean(w.chart, w.d_items, items.OLDER_SYSTEM, items.OLDER_SYSTEM_EXCLUDED_SUBJECTS),
        "avg_value",
    )


def _top_rows(w: Ward) -> DataFrame:
    rows = features.item_raw_mean(
        w.chart, w.d_items, items.OLDER_SYSTEM, items.OLDER_SYSTEM_EXCLUDED_SUBJECTS
    )
    return rounded(
        summary.top_rows(rounded(rows, "avg_value"), ["subject_id", "charttime", "itemid", "avg_value"], 1_000_000),
        "avg_value",
    )


def _grid_features(w: Ward) -> DataFrame:
    rows = rounded(grid.on_grid(grid.hourly_grid(w.bounds), w.features), *items.VITALS)
    return rows.withColumn("age", F.col("age").cast("double"))


def _temperature_pair(w: Ward) -> DataFrame:
    pair = rounded(features.temperature_pair(w.chart, w.adults, w.d_items), "temp_c", "temp_f")
    # either side may be missing
    return pair.withColumns({c: F.col(c).cast("double") for c in ("c_subject_id", "f_subject_id")})


def _grid_labels(w: Ward) -> DataFrame:
    return grid.with_labels(grid.hourly_grid(w.bounds), w.labels)


def _fill(filler) -> Query:
    def run(w: Ward) -> DataFrame:
        columns = [*items.VITALS, "age"]
        filled = filler(grid.on_grid(grid.hourly_grid(w.bounds), w.features), columns)
        return rounded(filled, *items.VITALS).withColumn("age", F.col("age").cast("double"))

    return run


def _matrix(labelled: bool) -> Query:
    def run(w: Ward) -> DataFrame:
        m = grid.labelled_matrix(w.features, w.bounds, w.labels if labelled else None)
        return rounded(m, *grid.MATRIX_VITALS, "gcs")

    return run


def _sampled_matrix(w: Ward) -> DataFrame:
    """The labelled matrix of a sample of patients; their ids filter events, stays and scores before any join."""
    drawn = cut_lineage(sampling.sample_patients(w.stays, SAMPLE_RATE))
    return _matrix(labelled=True)(w.restricted(drawn))


def _bounds(older: bool) -> Query:
    def run(w: Ward) -> DataFrame:
        if not older:
            return stay_bounds(w.stays.where(F.col("dbsource") == "metavision")).orderBy("subject_id")
        kept = w.stays.where(
            (F.col("dbsource") == "carevue")
            & ~F.col("subject_id").isin(*items.OLDER_SYSTEM_EXCLUDED_SUBJECTS)
        )
        return stay_bounds(kept).orderBy("subject_id")

    return run


def _stay_scores(w: Ward) -> DataFrame:
    return w.stays.select("subject_id", "icustay_id").join(
        w.scores.drop("subject_id"), "icustay_id"
    )


def _cohorts(w: Ward) -> dict[str, DataFrame]:
    def users(kind: str, above: float) -> DataFrame:
        return w.events.where((F.col("event_type") == kind) & (F.col("value") > above)).select(
            F.col("user_id").alias("subject_id")
        )

    return {
        "predicted": onset.onset(w.windows, w.scores),
        "martin": users("purchase", 150.0),
        "angus": users("error", 180.0),
        "explicit": users("view", 200.0),
    }


def _overlap(w: Ward) -> DataFrame:
    return rounded(cohorts.cohort_overlap(_cohorts(w)), "both_share", "left_share", "right_share")


def _common(w: Ward) -> DataFrame:
    return cohorts.common_subjects(w.inputs, w.cultures, w.scores)


def _common_scores(w: Ward) -> DataFrame:
    """Scores of the patients that have drugs, cultures and scores."""
    return cohorts.keep_common(w.scores, w.inputs, w.cultures)[0]


def _flag_counts(w: Ward) -> DataFrame:
    labs = w.table("lineitem").select(
        F.col("l_suppkey").alias("subject_id"), F.col("l_partkey").alias("itemid"),
        F.col("l_returnflag").alias("flag"),
    )
    names = w.table("part").select(F.col("p_partkey").alias("itemid"), F.col("p_name").alias("label"))
    return summary.item_counts(labs, names, "subject_id", "flag")


def _code_ranges(w: Ward) -> DataFrame:
    codes = w.table("lineitem").select(
        F.col("l_suppkey").alias("subject_id"), F.col("l_quantity").cast("int").alias("code")
    )
    sections = w.table("nation").select(
        (F.col("n_nationkey") * 2).alias("low"), (F.col("n_nationkey") * 2 + 4).alias("high"),
        F.col("n_name").alias("section"),
    )
    return summary.code_range_counts(codes, sections)


def _subject_slice(w: Ward) -> DataFrame:
    return summary.subject_rows(w.cultures, 64, ["charttime"])


def _sequence_index(w: Ward) -> DataFrame:
    rows = w.events.select(F.col("user_id").alias("seq_id"), "ts", "event_id")
    return ranking.row_index(rows, ["seq_id"], hour_number(F.col("ts")), ["ts", "event_id"])


def _split(w: Ward) -> DataFrame:
    sequences = w.stays.select((F.col("icustay_id") % 100).alias("file"), "icustay_id")
    return sampling.split_sequences(sequences, "file", "icustay_id")


def _edges(w: Ward) -> DataFrame:
    return graph.edges(w.graph_facts)


def _vertices(w: Ward) -> DataFrame:
    return graph.vertices(w.graph_patients, w.graph_facts)


def _pairs(w: Ward) -> DataFrame:
    return rounded(graph.jaccard_pairs(w.facts, SIMILAR), "similarity")


def _chosen_patient(w: Ward) -> Column:
    return w.facts.agg(F.min("patient_id")).scalar()


def _top_similar(w: Ward) -> DataFrame:
    return rounded(graph.jaccard_one_vs_all(w.graph_patients, w.facts, _chosen_patient(w)), "similarity")


def _random_walk(w: Ward) -> DataFrame:
    start = w.facts.agg(F.min("patient_id")).first()[0]
    return rounded(graph.random_walk(w.facts, start, iterations=WALK_STEPS), "rank", places=9)


def _top_similar_kinds(w: Ward) -> DataFrame:
    chosen = w.graph_facts.agg(F.min("patient_id")).scalar()
    return rounded(graph.jaccard_one_vs_all(w.graph_patients, w.graph_facts, chosen), "similarity")


def _random_walk_kinds(w: Ward) -> DataFrame:
    start = w.graph_facts.agg(F.min("patient_id")).first()[0]
    return rounded(graph.random_walk(w.graph_facts, start, iterations=WALK_STEPS), "rank", places=9)


def _affinity(w: Ward) -> DataFrame:
    return rounded(graph.code_affinity(w.graph_facts, iterations=2, tolerance=0.0), "value")


def _clusters(w: Ward) -> DataFrame:
    return graph.code_clusters(w.graph_facts)


def _path_loglik(w: Ward) -> DataFrame:
    return rounded(decode.path_log_probability(w.labelled_steps, REAL_MODEL), "log_probability")


def _fit_multi(w: Ward) -> DataFrame:
    rows = w.table("embeddings").select(F.col("label").alias("state"), F.col("embedding").alias("obs"))
    # the column holds floats; sums run on doubles
    rows = rows.withColumn("obs", F.col("obs").cast("array<double>"))
    return rounded(fit.fit_multi(rows), "mean_i", "mean_j", "covariance")


def _vector_arithmetic(w: Ward) -> DataFrame:
    """Each vector against its label's mean: sum, difference and distance."""
    vec = w.table("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    centre = vec.groupBy("label").agg(
        vector_to_array(Summarizer.mean(array_to_vector(F.col("x")))).alias("c")
    )
    joined = vec.join(centre, "label")
    folded = lambda a: F.aggregate(a, F.lit(0.0), lambda t, v: t + v)
    return joined.select(
        "vec_id",
        F.round(euclidean(F.col("x"), F.col("c")), 6).alias("distance"),
        F.round(folded(vector_add(F.col("x"), F.col("c"))), 6).alias("added"),
        F.round(folded(vector_subtract(F.col("x"), F.col("c"))), 6).alias("subtracted"),
        F.round(folded(vector_scale(F.col("x"), 2.5)), 6).alias("scaled"),
    )


def _matrix_steps(w: Ward) -> DataFrame:
    """The matrix as vector sequences: (seq_id, t, obs) with the eight model features."""
    return w.matrix.select(
        F.col("icustay_id").alias("seq_id"),
        hour_number(F.col("charttime")).alias("t"),
        F.array(*[F.col(c).cast("double") for c in SEQUENCE_COLUMNS]).alias("obs"),
    )


def _hmm_rows(w: Ward, model: Hmm) -> DataFrame:
    return train.model_rows(w.spark, model)


def _baum_welch(w: Ward) -> DataFrame:
    return _hmm_rows(w, train.baum_welch(w.steps, train.gaussian_start(w.steps)))


def _baum_welch_step(w: Ward) -> DataFrame:
    """One round from a fixed model, which plain SQL can follow."""
    return rounded(_hmm_rows(w, train.baum_welch(w.steps, REAL_MODEL, iterations=1)), "value")


def _vector_hmm_predict(w: Ward) -> DataFrame:
    """Two-state vector model on the six vitals and age, then the states of every hour."""
    columns = (*grid.MATRIX_VITALS, "age")
    steps = cut_lineage(
        w.matrix.select(
            F.col("icustay_id").alias("seq_id"),
            hour_number(F.col("charttime")).alias("t"),
            F.array(*[F.col(c).cast("double") for c in columns]).alias("obs"),
        )
    )
    model = train.baum_welch(steps, train.vector_start(steps, len(columns)), iterations=VECTOR_ROUNDS)
    return decode.posterior(steps, model)


def _baum_welch_table(w: Ward) -> DataFrame:
    return _hmm_rows(w, train.baum_welch(w.type_steps, TABLE_MODEL))


def _hmm_kmeans(w: Ward) -> DataFrame:
    return _hmm_rows(w, train.kmeans_learn(w.steps, Gaussian(0.0, 1.0), k=2))


def _gaussian_hmm_predict(w: Ward) -> DataFrame:
    model = train.baum_welch(w.steps, train.gaussian_start(w.steps), iterations=25)
    return decode.posterior(w.steps, model)


def _held_out(w: Ward) -> DataFrame:
    """Three quarters of each file's sequences fit the model, the others are scored by it."""
    sequences = w.steps.select("seq_id", (F.col("seq_id") % 10).alias("file")).distinct()
    split = cut_lineage(sampling.split_sequences(sequences, "file", "seq_id"))
    return rounded(train.held_out(w.steps, split)[1], "log_likelihood", "per_step")


def _kmeans(w: Ward) -> DataFrame:
    points = w.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    centres = kmeans.kmeans(points, "x", ["vec_id"], 10)
    return kmeans.assign(points, "x", centres).select("vec_id", "cluster")


def _elastic_net(w: Ward) -> DataFrame:
    matrix = w.matrix
    return classify.coefficients(classify.fit_elastic_net(matrix), matrix)


def _sgd(w: Ward) -> DataFrame:
    return classify.sgd_probabilities(w.matrix, ["icustay_id", "charttime"])


def _stay_lines(w: Ward) -> DataFrame:
    """Stays as lines: some without an admission time, some with an impossible time, some cut short."""
    made = rows.row_lines(w.stays.select("subject_id", "icustay_id", "intime", "outtime"))
    parts = F.split("line", ",")
    # the numbers are read from the line again, as a foreign file would have them
    stay = parts[1].cast("long")
    line = (
        F.when(stay % 13 == 0, F.concat_ws(",", parts[0], parts[1], parts[2], F.lit("2024-13-45 99:00:00")))
        .when(stay % 17 == 0, F.concat_ws(",", parts[0], parts[1]))
        .when(stay % 11 == 0, F.concat_ws(",", parts[0], parts[1], F.lit(""), parts[3]))
        .otherwise(F.col("line"))
    )
    return made.select(line.alias("line"))


def _chart_lines(w: Ward) -> DataFrame:
    """Chart rows as lines: some values are words, some times are blank."""
    value = F.when(F.col("itemid") == 211, F.lit("not done")).otherwise(F.round("valuenum", 6).cast("string"))
    time = F.when(F.col("itemid") != 618, F.date_format("charttime", "yyyy-MM-dd HH:mm:ss"))
    return w.chart.select(F.concat_ws(",", "subject_id", F.coalesce(time, F.lit("")), "itemid", value).alias("line"))


def _reasons(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _read_wide(w: Ward) -> DataFrame:
    """Wide hours through lines; those without a time are rejects."""
    made = rows.row_lines(rounded(w.features, *items.VITALS))
    return rows.parse_rows(made, rows.WIDE_ROW, ["charttime"]).rows


def _read_labels(w: Ward) -> DataFrame:
    """Labels through lines; every fifth subject's have a field too many."""
    made = rows.row_lines(w.labels.select("subject_id", "icustay_id", "charttime"))
    extra = F.split("line", ",")[0].cast("long") % 5 == 0
    lines = made.select(F.when(extra, F.concat("line", F.lit(",1"))).otherwise(F.col("line")).alias("line"))
    return rows.parse_rows(lines, rows.LABEL_ROW, ["subject_id", "icustay_id", "charttime"]).rows


def _read_cohort(w: Ward) -> DataFrame:
    """Distinct ids of a one-column file, in which some ids have a letter and some lines are blank."""
    who = F.col("user_id")
    line = F.when(who % 7 == 0, F.concat(who, F.lit("x"))).when(who % 7 == 1, F.lit(" ")).otherwise(F.concat(F.lit(" "), who))
    lines = w.events.select(line.alias("line"))
    return rows.parse_rows(lines, rows.COHORT_ROW, ["subject_id"]).rows.distinct()


def _parse_tuples(w: Ward) -> DataFrame:
    parsed = text.parse_labelled(text.labelled_lines(w.matrix))
    return rounded(
        parsed.select(
            "icustay_id", "charttime", "label",
            *[F.col("features")[i].alias(c) for i, c in enumerate(grid.MATRIX_VITALS)],
            "gcs", "age",
        ),
        *grid.MATRIX_VITALS, "gcs",
    )


def _parse_matrix(w: Ward) -> DataFrame:
    fields = text.parse_matrix(text.labelled_lines(w.matrix), start=5)
    names = ("icustay_id", None, *SEQUENCE_COLUMNS)
    return fields.select(
        *[
            F.round(F.col("fields")[i].cast("double"), 6).alias(n)
            for i, n in enumerate(names)
            if n is not None
        ]
    )


def _parse_sequences(w: Ward) -> DataFrame:
    sequences = cohorts.stay_sequences(w.matrix, SEQUENCE_COLUMNS).select(
        F.col("icustay_id").alias("seq_id"), "sequence"
    )
    steps = text.parse_sequence_lines(text.sequence_lines(sequences), width=8)
    kept = cohorts.long_sequences(steps, "obs", width=8, min_length=7)
    return kept.select(
        F.col("seq_id").cast("long").alias("seq_id"), "t",
        *[F.round(F.col("obs")[i], 6).alias(c) for i, c in enumerate(SEQUENCE_COLUMNS)],
    )


def _parse_posteriors(w: Ward) -> DataFrame:
    indexed = decode.posterior(w.steps, REAL_MODEL).withColumn(
        "t", (F.col("t") - hour_number(F.lit("2024-01-01").cast("timestamp_ntz"))).cast("int")
    )
    return rounded(text.parse_posteriors(text.posterior_lines(indexed)), "p0", "p1")


def _parse_scalars(w: Ward) -> DataFrame:
    return rounded(text.parse_scalars(text.scalar_lines(w.steps), "seq_id"), "obs")


def _parse_bracketed(w: Ward) -> DataFrame:
    steps = text.parse_bracketed(text.bracketed_lines(_matrix_steps(w)), "seq_id")
    return steps.select(
        "seq_id", "t", *[F.round(F.col("obs")[i], 6).alias(c) for i, c in enumerate(SEQUENCE_COLUMNS)]
    )


def _first_raw(w: Ward) -> DataFrame:
    return rounded(features.first_raw_readings(w.chart, w.adults, items.DIASTOLIC, d_items=w.d_items), "value")


def _labelled_raw_mean(w: Ward) -> DataFrame:
    return rounded(features.labelled_raw_mean(w.chart, w.d_items, items.LONG_FORM), "avg_value")


def _stay_sequence_lengths(w: Ward) -> DataFrame:
    return cohorts.stay_sequences(w.matrix, SEQUENCE_COLUMNS).select("icustay_id", "length")


QUERIES: dict[str, Query] = {
    # features
    "bp_dia_hourly": _ladder(items.DIASTOLIC),
    "bp_sys_hourly": _ladder(items.SYSTOLIC),
    "eye_hourly": _ladder(items.EYE),
    "eye3_hourly": _ladder(items.EYE_WIDE),
    "verbal_hourly": _ladder(items.VERBAL),
    "motor_hourly": _ladder(items.MOTOR),
    "temp_hourly": _ladder(items.TEMPERATURE),
    "single_feature": _ladder((items.HEART_RATE,), with_item=False),
    "item_hourly_mean": _family(items.EASY_VITALS),
    "bp_item_hourly_mean": _family(items.SYSTOLIC, adults_only=False),
    "gcs_item_hourly_mean": _family(items.GCS_REGULAR),
    "apache2_item_hourly_mean": _family(items.GCS_APACHE2),
    "apache4_item_hourly_mean": _family(items.GCS_APACHE4),
    "temp_item_hourly_mean": _family(items.TEMPERATURE),
    "item_raw_mean": _raw_mean,
    "labelled_raw_mean": _labelled_raw_mean,
    "first_raw_readings": _first_raw,
    "adult_stays": lambda w: rounded(w.adults, "age"),
    "stay_bounds": _bounds(older=False),
    "older_stay_bounds": _bounds(older=True),
    "wide_features": _wide,
    "temp_cf_full_join": _temperature_pair,
    # grid
    "hourly_grid": lambda w: grid.hourly_grid(w.bounds),
    "grid_features": _grid_features,
    "grid_labels": _grid_labels,
    "fill_forward": _fill(grid.fill_forward),
    "fill_both": _fill(grid.fill_both),
    "labelled_matrix": _matrix(labelled=True),
    "unlabelled_matrix": _matrix(labelled=False),
    "sampled_matrix": _sampled_matrix,
    # onset
    "infection_pairs": lambda w: w.windows,
    "score_windows": lambda w: onset.score_windows(w.windows, w.scores),
    "score_max_rise": lambda w: onset.score_history(w.scores),
    "onset_by_subject": lambda w: onset.onset(w.windows, w.scores),
    "onset_by_stay": lambda w: w.labels,
    "stay_scores": _stay_scores,
    # summaries and cohorts
    "item_counts": lambda w: summary.item_counts(w.chart, w.d_items),
    "flag_counts": _flag_counts,
    "drug_counts": lambda w: summary.value_counts(
        w.table("part").withColumnRenamed("p_name", "drug"), "drug", "gear"
    ),
    "label_search": lambda w: summary.matching(w.drug_items, "label", "bolt"),
    "subject_slice": _subject_slice,
    "code_range_counts": _code_ranges,
    "cohort_overlap": _overlap,
    "common_patients": _common,
    "common_scores": _common_scores,
    "non_septic": lambda w: cohorts.non_septic(w.stays, w.labels),
    "stay_label": lambda w: cohorts.stay_labels(w.matrix),
    "stay_lengths": lambda w: cohorts.stay_lengths(w.matrix, 7),
    "stay_sequence_lengths": _stay_sequence_lengths,
    "top_rows": _top_rows,
    "sequence_index": _sequence_index,
    # sampling
    "sample_patients": lambda w: sampling.sample_patients(w.stays, SAMPLE_RATE),
    "sample_strata": lambda w: sampling.sample_strata(w.stays, w.labels, SAMPLE_RATE),
    "stratum_counts": lambda w: sampling.stratum_counts(w.stays, w.labels),
    "sampled_scores": lambda w: sampling.keep_subjects(
        w.scores, sampling.sample_patients(w.stays, SAMPLE_RATE)
    ),
    "split_sequences": _split,
    # graph
    "graph_vertices": _vertices,
    "graph_edges": _edges,
    "jaccard_all": _pairs,
    "jaccard_top10": _top_similar,
    "random_walk": _random_walk,
    "jaccard_top10_kinds": _top_similar_kinds,
    "random_walk_kinds": _random_walk_kinds,
    "code_affinity": _affinity,
    "pic_clusters": _clusters,
    # sequence models
    "transition_counts": lambda w: fit.transition_counts(w.labelled_steps),
    "initial_states": lambda w: fit.initial_states(w.labelled_steps),
    "fit_integer": lambda w: rounded(
        fit.fit_table(w.weighted_events.withColumnRenamed("level", "obs"), "weight"), "probability"
    ),
    "fit_gaussian": lambda w: rounded(
        fit.fit_gaussian(w.weighted_events.withColumnRenamed("value", "obs"), "weight"),
        "mean", "variance", places=4,
    ),
    "fit_multi": _fit_multi,
    "fit_mixture_step": lambda w: rounded(
        fit.fit_mixture_step(w.weighted_events.withColumnRenamed("value", "obs"), MIXTURE, "weight"),
        "weight", "mean", "variance", places=4,
    ),
    "vector_arithmetic": _vector_arithmetic,
    "seq_loglik": lambda w: rounded(decode.log_likelihoods(w.steps, REAL_MODEL), "log_likelihood"),
    "seq_probability": lambda w: decode.probabilities(w.type_steps, TABLE_MODEL).withColumn(
        "probability", F.round(F.log(F.col("probability")), 6)
    ),
    "path_loglik": _path_loglik,
    "viterbi_path": lambda w: rounded(decode.viterbi(w.steps, REAL_MODEL), "path_log_probability"),
    "posterior": lambda w: rounded(decode.posterior(w.steps, REAL_MODEL), "p0", "p1"),
    "posterior_mass": lambda w: rounded(decode.posterior_mass(w.steps, REAL_MODEL), "mass", places=4),
    "model_gap": lambda w: rounded(decode.model_gap(w.steps, REAL_MODEL, OTHER_MODEL), "gap"),
    "baum_welch": _baum_welch,
    "baum_welch_step": _baum_welch_step,
    "baum_welch_table": _baum_welch_table,
    "gaussian_hmm_predict": _gaussian_hmm_predict,
    "vector_hmm_predict": _vector_hmm_predict,
    "hmm_held_out": _held_out,
    "hmm_kmeans": _hmm_kmeans,
    "kmeans": _kmeans,
    # classifiers
    "elastic_net": _elastic_net,
    "sgd_logit": _sgd,
    # files of rows
    "read_wide_rows": _read_wide,
    "read_stay_rows": lambda w: rows.parse_rows(_stay_lines(w), rows.STAY_ROW, ["intime"]).rows,
    "read_stay_rejects": lambda w: _reasons(rows.parse_rows(_stay_lines(w), rows.STAY_ROW, ["intime"]).rejects),
    "read_label_rows": _read_labels,
    "read_chart_rows": lambda w: rows.parse_rows(_chart_lines(w), rows.CHART_ROW, ["charttime"]).rows,
    "read_chart_rejects": lambda w: _reasons(rows.parse_rows(_chart_lines(w), rows.CHART_ROW, ["charttime"]).rejects),
    "read_cohort_rows": _read_cohort,
    # line formats
    "parse_tuples": _parse_tuples,
    "parse_matrix": _parse_matrix,
    "parse_sequences": _parse_sequences,
    "parse_posteriors": _parse_posteriors,
    "parse_scalars": _parse_scalars,
    "parse_bracketed": _parse_bracketed,
}
