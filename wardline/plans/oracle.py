"""The same queries as DuckDB SQL, written from the definitions rather than from the plans."""

from __future__ import annotations

from collections.abc import Sequence

from wardline.functions import items
from wardline.plans.bindings import SQL_TABLES
from wardline.plans.queries import (
    MIXTURE,
    OTHER_MODEL,
    REAL_MODEL,
    SAMPLE_RATE,
    SEQUENCE_COLUMNS,
    SIMILAR,
    TABLE_MODEL,
    WALK_STEPS,
)

VITALS = items.VITALS


def _in(ids: Sequence[int]) -> str:
    return "(" + ", ".join(map(str, ids)) + ")"


def _list(ids: Sequence[int]) -> str:
    return "[" + ", ".join(map(str, ids)) + "]"


def _matched(stays: str) -> str:
    return (
        "SELECT c.subject_id, s.icustay_id, date_trunc('hour', c.charttime) AS charttime, c.itemid, c.valuenum "
        f"FROM chart c JOIN d_items d ON c.itemid = d.itemid JOIN {stays} s ON c.subject_id = s.subject_id "
        "AND c.charttime >= s.intime AND c.charttime <= s.outtime"
    )


_MEANS = (
    "SELECT * FROM (SELECT subject_id, icustay_id, charttime, itemid, avg(valuenum) AS avg_value "
    "FROM {rows} GROUP BY ALL) WHERE avg_value != 0"
)
_FAHRENHEIT = "CASE WHEN {v} < 50 THEN {v} * 9.0 / 5.0 + 32 ELSE {v} END"


def _ladder(ladder: Sequence[int], name: str = "value", with_item: bool = True, temperature: bool = False) -> str:
    rank = f"list_position({_list(ladder)}, itemid)"
    value = f"arg_min(avg_value, {rank})"
    item = f"arg_min(itemid, {rank})"
    if temperature:
        value, item = _FAHRENHEIT.format(v=value), "223761"
    return (
        "SELECT subject_id, icustay_id, charttime, "
        + (f"CAST({item} AS INTEGER) AS itemid, " if with_item else "")
        + f"{value} AS {name} FROM means WHERE itemid IN {_in(ladder)} GROUP BY subject_id, icustay_id, charttime"
    )


def _density(model, x: str, state: int) -> str:
    em = model.emissions[state]
    if hasattr(em, "variance"):
        return (
            f"exp(-(({x}) - {em.mean!r}) * (({x}) - {em.mean!r}) / (2 * {em.variance!r})) "
            f"/ sqrt(2 * pi() * {em.variance!r})"
        )
    return f"[{', '.join(map(repr, em.probabilities))}][{x} + 1]"


def _observed(model, source: str) -> str:
    return (
        f"SELECT seq_id, t, row_number() OVER (PARTITION BY seq_id ORDER BY t) AS n, "
        f"{_density(model, 'obs', 0)} AS d0, {_density(model, 'obs', 1)} AS d1 FROM {source}"
    )


def _forward(model, observed: str) -> str:
    p, a = model.initial, model.transitions
    return (
        f"SELECT seq_id, n, {p[0]} * d0 / ({p[0]} * d0 + {p[1]} * d1) AS a0, "
        f"{p[1]} * d1 / ({p[0]} * d0 + {p[1]} * d1) AS a1, ln({p[0]} * d0 + {p[1]} * d1) AS ll "
        f"FROM {observed} WHERE n = 1 UNION ALL "
        "SELECT seq_id, n, u0 / (u0 + u1), u1 / (u0 + u1), ll + ln(u0 + u1) FROM ("
        f"SELECT o.seq_id, o.n, (f.a0 * {a[0][0]} + f.a1 * {a[1][0]}) * o.d0 AS u0, "
        f"(f.a0 * {a[0][1]} + f.a1 * {a[1][1]}) * o.d1 AS u1, f.ll "
        f"FROM {{self}} f JOIN {observed} o ON o.seq_id = f.seq_id AND o.n = f.n + 1)"
    )


_BACK = (
    "SELECT seq_id, n, 1.0::DOUBLE AS b0, 1.0::DOUBLE AS b1 FROM (SELECT seq_id, max(n) AS n FROM observed GROUP BY seq_id) "
    "UNION ALL SELECT seq_id, n, v0 / (v0 + v1), v1 / (v0 + v1) FROM ("
    "SELECT b.seq_id, b.n - 1 AS n, {a00} * o.d0 * b.b0 + {a01} * o.d1 * b.b1 AS v0, "
    "{a10} * o.d0 * b.b0 + {a11} * o.d1 * b.b1 AS v1 "
    "FROM bwd b JOIN observed o ON o.seq_id = b.seq_id AND o.n = b.n WHERE b.n > 1)"
)


def _a(model) -> dict[str, float]:
    return {f"a{i}{j}": model.transitions[i][j] for i in (0, 1) for j in (0, 1)}


def _viterbi_tables() -> dict[str, tuple[str, tuple[str, ...]]]:
    p, a = REAL_MODEL.initial, _a(REAL_MODEL)
    step = (
        "SELECT o.seq_id, o.n, o.d0, o.d1, f.s0 + ln({a00}) AS p00, f.s1 + ln({a10}) AS p10, "
        "f.s0 + ln({a01}) AS p01, f.s1 + ln({a11}) AS p11 "
        "FROM best f JOIN observed o ON o.seq_id = f.seq_id AND o.n = f.n + 1"
    ).format(**a)
    best = (
        f"SELECT seq_id, n, ln({p[0]}) + ln(d0) AS s0, ln({p[1]}) + ln(d1) AS s1, 0 AS f0, 0 AS f1 "
        "FROM observed WHERE n = 1 UNION ALL "
        "SELECT seq_id, n, greatest(p00, p10) + ln(d0), greatest(p01, p11) + ln(d1), "
        f"CASE WHEN p10 > p00 THEN 1 ELSE 0 END, CASE WHEN p11 > p01 THEN 1 ELSE 0 END FROM ({step})"
    )
    path = (
        "SELECT b.seq_id, b.n, CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS state, greatest(s0, s1) AS lp "
        "FROM best b JOIN (SELECT seq_id, max(n) AS n FROM observed GROUP BY seq_id) m "
        "ON b.seq_id = m.seq_id AND b.n = m.n "
        "UNION ALL SELECT p.seq_id, p.n - 1, CASE WHEN p.state = 1 THEN b.f1 ELSE b.f0 END, p.lp "
        "FROM path p JOIN best b ON b.seq_id = p.seq_id AND b.n = p.n WHERE p.n > 1"
    )
    return {"best": (best, ("observed",)), "path": (path, ("best",))}


_WINDOW_SCORES = (
    "SELECT w.{keys}, w.charttime, w.starttime, s.score, greatest(0, s.score - least(99, coalesce("
    "min(s.score) OVER (PARTITION BY w.{keys}, w.charttime, w.starttime ORDER BY s.starttime, s.icustay_id, s.score "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 99))) AS rise "
    "FROM {windows} w JOIN {scores} s ON {on} AND s.starttime >= w.charttime AND s.starttime <= w.starttime"
)


def _windows(keys: str, inputs: str) -> str:
    return (
        f"SELECT DISTINCT i.{keys}, date_trunc('hour', m.charttime) AS charttime, i.starttime "
        f"FROM {inputs} i JOIN drug_items d ON i.itemid = d.itemid AND d.category = 'Antibiotics' "
        "JOIN cultures m ON i.subject_id = m.subject_id "
        f"WHERE m.org_name IS NOT NULL AND m.charttime IS NOT NULL AND m.spec_itemid IN {_in(items.CULTURE_SPECIMENS)} "
        "AND (epoch_us(i.starttime) - epoch_us(m.charttime) BETWEEN 0 AND 72 * 3600000000 "
        "OR epoch_us(m.charttime) - epoch_us(i.starttime) BETWEEN 0 AND 24 * 3600000000)"
    )


_FILL_COLUMNS = (*VITALS, "age")
_PAST = (
    "OVER (PARTITION BY subject_id, icustay_id ORDER BY charttime "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)
_FUTURE = (
    "OVER (PARTITION BY subject_id, icustay_id ORDER BY charttime "
    "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
)
_STAY_HOUR = "subject_id, icustay_id, charttime"

_wide_parts = {
    f"t_{n}": (_ladder(ladder, n, with_item=False, temperature=n == "temp_f"), ("means",))
    for n, ladder in items.WIDE_FEATURES.items()
}
_full_join = " FULL JOIN ".join(
    f"t_{n}" if k == 0 else f"t_{n} USING (subject_id, icustay_id, charttime)"
    for k, n in enumerate(VITALS)
)

def _walk_tables(held: str = "held", kinds: str = "") -> dict[str, tuple[str, tuple[str, ...]]]:
    """The walk written out, one pair of tables per round trip."""
    sizes, codes, walk, reach = (f"{kinds}{t}" for t in ("sizes", "code_sizes", "walk", "reach"))
    out = {
        codes: (f"SELECT code, count(*) AS n FROM {held} GROUP BY ALL", (held,)),
        f"{walk}_0": (f"SELECT min(patient_id) AS patient_id, 1.0::DOUBLE AS rank FROM {held}", (held,)),
    }
    for i in range(1, WALK_STEPS // 2 + 1):
        out[f"{reach}_{i}"] = (
            f"SELECT h.code, sum(p.rank / s.n) * 0.85 AS rank FROM {held} h JOIN {walk}_{i - 1} p "
            f"ON h.patient_id = p.patient_id JOIN {sizes} s ON s.patient_id = h.patient_id GROUP BY h.code",
            (held, sizes, f"{walk}_{i - 1}"),
        )
        out[f"{walk}_{i}"] = (
            "SELECT patient_id, sum(part) AS rank FROM (SELECT h.patient_id, r.rank / s.n * 0.85 AS part "
            f"FROM {held} h JOIN {reach}_{i} r ON h.code = r.code JOIN {codes} s ON s.code = h.code "
            f"UNION ALL SELECT min(patient_id), 0.15 FROM {held}) GROUP BY patient_id",
            (held, codes, f"{reach}_{i}"),
        )
    return out


def _top_similar(held: str, sizes: str) -> str:
    return _sql(
        "SELECT patient_id, round(similarity, 6) AS similarity FROM ("
        f"SELECT c.c_custkey AS patient_id, coalesce(k, 0) / (coalesce(n, 0) + (SELECT count(*) FROM {held} "
        f"WHERE patient_id = (SELECT min(patient_id) FROM {held})) - coalesce(k, 0))::DOUBLE AS similarity "
        f"FROM customer c LEFT JOIN {sizes} s ON s.patient_id = c_custkey LEFT JOIN ("
        f"SELECT y.patient_id, count(*) AS k FROM {held} x JOIN {held} y ON x.code = y.code "
        f"WHERE x.patient_id = (SELECT min(patient_id) FROM {held}) GROUP BY ALL) o ON o.patient_id = c_custkey "
        f"WHERE c_custkey != (SELECT min(patient_id) FROM {held})) t "
        "ORDER BY t.similarity DESC, t.patient_id LIMIT 10",
        held, sizes,
    )


def _walk(held: str, walk: str) -> str:
    return _sql(f"SELECT patient_id, round(rank, 9) AS rank FROM {walk} WHERE patient_id != (SELECT min(patient_id) FROM {held})", held, walk)


def _affinity_tables() -> dict[str, tuple[str, tuple[str, ...]]]:
    """Two rounds of the normalised affinity of shared codes, from all pairs of patients."""
    out = {
        "affinity": (
            "SELECT x.patient_id AS a, y.patient_id AS b, count(*) / sqrt(any_value(s.n) * any_value(t.n)) AS w FROM kinds_held x "
            "JOIN kinds_held y ON x.code = y.code AND x.patient_id != y.patient_id JOIN kinds_sizes s ON s.patient_id = x.patient_id "
            "JOIN kinds_sizes t ON t.patient_id = y.patient_id GROUP BY x.patient_id, y.patient_id",
            ("kinds_held", "kinds_sizes"),
        ),
        "affinity_0": ("SELECT a, sum(w) AS d, sum(w) AS v FROM affinity GROUP BY a", ("affinity",)),
    }
    for i in (1, 2):
        out[f"affinity_{i}"] = (
            f"SELECT x.a, any_value(p.d) AS d, sum(w * q.v) / any_value(p.d) AS v FROM affinity x JOIN affinity_{i - 1} p ON p.a = x.a "
            f"JOIN affinity_{i - 1} q ON q.a = x.b GROUP BY x.a",
            ("affinity", f"affinity_{i - 1}"),
        )
    return out


def _round_of_training() -> str:
    a = _a(REAL_MODEL)
    w = {f"{i}{j}": f"f.a{i} * {a[f'a{i}{j}']} * o.d{j} * b.b{j}" for i in (0, 1) for j in (0, 1)}
    whole = " + ".join(w.values())
    moves = ", ".join(f"sum(({v}) / ({whole})) AS w{k}" for k, v in w.items())
    parts = [
        f"SELECT 'initial' AS parameter, {i} AS state, 0 AS position, avg(p{i}) AS value FROM "
        "(SELECT seq_id, arg_min(p0, t) AS p0, arg_min(p1, t) AS p1 FROM gammas GROUP BY seq_id)"
        for i in (0, 1)
    ]
    parts += [
        f"SELECT 'transition', {i}, {j}, w{i}{j} / (w{i}0 + w{i}1) FROM (SELECT {moves} FROM fwd f "
        "JOIN observed o ON o.seq_id = f.seq_id AND o.n = f.n + 1 JOIN bwd b ON b.seq_id = f.seq_id AND b.n = f.n + 1)"
        for i in (0, 1)
        for j in (0, 1)
    ]
    for i in (0, 1):
        means = f"SELECT sum(p{i} * obs) / sum(p{i}) AS m FROM gammas JOIN steps USING (seq_id, t)"
        parts.append(f"SELECT 'mean', {i}, 0, m FROM ({means})")
        parts.append(
            f"SELECT 'variance', {i}, 0, sum(p{i} * (obs - m) * (obs - m)) / sum(p{i}) "
            f"FROM gammas JOIN steps USING (seq_id, t), ({means})"
        )
    return "SELECT parameter, state, position, round(value, 6) AS value FROM (" + " UNION ALL ".join(parts) + ")"


EXTRA: dict[str, tuple[str, tuple[str, ...]]] = {
    "matched": (_matched("adults"), ("chart", "adults", "d_items")),
    "means": (_MEANS.format(rows="matched"), ("matched",)),
    "matched_all": (_matched("stays"), ("chart", "stays", "d_items")),
    "means_all": (_MEANS.format(rows="matched_all"), ("matched_all",)),
    **_wide_parts,
    "hours": (f"SELECT * FROM {_full_join}", tuple(_wide_parts)),
    "wide": (
        "SELECT coalesce(h.subject_id, a.subject_id) AS subject_id, coalesce(h.icustay_id, a.icustay_id) AS icustay_id, "
        f"h.charttime, {', '.join(VITALS)}, CAST(round_even(age, 0) AS INTEGER) AS age "
        "FROM hours h FULL JOIN (SELECT * FROM adults WHERE dbsource = 'metavision') a "
        "ON h.icustay_id = a.icustay_id WHERE age < 150",
        ("hours", "adults"),
    ),
    "bounds": (
        "SELECT subject_id, icustay_id, date_trunc('hour', intime) AS intime, "
        "date_trunc('hour', outtime + INTERVAL 30 MINUTE) AS outtime FROM stays WHERE dbsource = 'metavision'",
        ("stays",),
    ),
    "grid": (
        "SELECT subject_id, icustay_id, intime + to_hours(CAST(step AS INTEGER)) AS charttime FROM (SELECT *, "
        "unnest(range(0, 1 + CAST(greatest(0, ceil((epoch_us(outtime) - epoch_us(intime)) / 3600000000.0)) AS BIGINT))) "
        "AS step FROM bounds)",
        ("bounds",),
    ),
    "grid_wide": (
        f"SELECT g.*, {', '.join(VITALS)}, age FROM grid g LEFT JOIN wide w ON g.subject_id = w.subject_id "
        "AND g.icustay_id = w.icustay_id AND g.charttime = w.charttime",
        ("grid", "wide"),
    ),
    "forward": (
        f"SELECT {_STAY_HOUR}, "
        + ", ".join(f"last_value({c} IGNORE NULLS) {_PAST} AS {c}" for c in _FILL_COLUMNS)
        + " FROM grid_wide",
        ("grid_wide",),
    ),
    "filled": (
        f"SELECT {_STAY_HOUR}, "
        + ", ".join(f"coalesce({c}, first_value({c} IGNORE NULLS) {_FUTURE}) AS {c}" for c in _FILL_COLUMNS)
        + " FROM forward",
        ("forward",),
    ),
    "windows": (_windows("subject_id", "inputs"), ("inputs", "drug_items", "cultures")),
    "stay_inputs": (
        "SELECT i.* FROM inputs i JOIN (SELECT subject_id AS sid FROM stays) s ON i.subject_id = s.sid",
        ("inputs", "stays"),
    ),
    "stay_windows": (
        _windows("subject_id, i.icustay_id", "stay_inputs"), ("stay_inputs", "drug_items", "cultures")
    ),
    "adult_scores": (
        "SELECT s.* FROM scores s JOIN adults a ON s.icustay_id = a.icustay_id AND s.subject_id = a.subject_id",
        ("scores", "adults"),
    ),
    "window_scores": (
        _WINDOW_SCORES.format(
            keys="subject_id", windows="windows", scores="scores", on="w.subject_id = s.subject_id"
        ),
        ("windows", "scores"),
    ),
    "stay_window_scores": (
        _WINDOW_SCORES.format(
            keys="subject_id, w.icustay_id", windows="stay_windows", scores="adult_scores",
            on="w.subject_id = s.subject_id AND w.icustay_id = s.icustay_id",
        ),
        ("stay_windows", "adult_scores"),
    ),
    "septic": (
        "SELECT subject_id, min(charttime) AS charttime FROM (SELECT subject_id, charttime, starttime, "
        "max(rise) AS rise FROM window_scores GROUP BY ALL) WHERE rise >= 2 GROUP BY subject_id",
        ("window_scores",),
    ),
    "onsets": (
        "SELECT subject_id, icustay_id, min(charttime) AS charttime FROM (SELECT subject_id, icustay_id, charttime, "
        "starttime, max(rise) AS rise FROM stay_window_scores GROUP BY ALL) WHERE rise >= 2 "
        "GROUP BY subject_id, icustay_id",
        ("stay_window_scores",),
    ),
    "matrix": (
        f"SELECT {_STAY_HOUR}, label, bp_dia, bp_sys, heart_rate, resp_rate, temp_f, spo2, "
        "eye_opening + verbal + motor AS gcs, age FROM (SELECT f.*, CASE WHEN o.icustay_id IS NULL THEN 0 ELSE 1 END AS label "
        "FROM filled f LEFT JOIN onsets o ON f.subject_id = o.subject_id AND f.icustay_id = o.icustay_id "
        "AND f.charttime = o.charttime) WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in _FILL_COLUMNS),
        ("filled", "onsets"),
    ),
    "observed": (_observed(REAL_MODEL, "steps"), ("steps",)),
    "fwd": (_forward(REAL_MODEL, "observed").replace("{self}", "fwd"), ("observed",)),
    "bwd": (_BACK.format(**_a(REAL_MODEL)), ("observed",)),
    "other_observed": (_observed(OTHER_MODEL, "steps"), ("steps",)),
    "other_fwd": (_forward(OTHER_MODEL, "other_observed").replace("{self}", "other_fwd"), ("other_observed",)),
    "type_observed": (_observed(TABLE_MODEL, "type_steps"), ("type_steps",)),
    "type_fwd": (_forward(TABLE_MODEL, "type_observed").replace("{self}", "type_fwd"), ("type_observed",)),
    **_viterbi_tables(),
    "gammas": (
        "SELECT f.seq_id, o.t, a0 * b0 / (a0 * b0 + a1 * b1) AS p0, a1 * b1 / (a0 * b0 + a1 * b1) AS p1 "
        "FROM fwd f JOIN bwd b ON f.seq_id = b.seq_id AND f.n = b.n JOIN observed o ON o.seq_id = f.seq_id AND o.n = f.n",
        ("fwd", "bwd"),
    ),
    "held": ("SELECT DISTINCT patient_id, code FROM facts", ("facts",)),
    "sizes": ("SELECT patient_id, count(*) AS n FROM held GROUP BY ALL", ("held",)),
    **_walk_tables(),
    "kinds_held": ("SELECT DISTINCT patient_id, kind || ':' || code AS code FROM graph_facts", ("graph_facts",)),
    "kinds_sizes": ("SELECT patient_id, count(*) AS n FROM kinds_held GROUP BY ALL", ("kinds_held",)),
    **_walk_tables("kinds_held", "kinds_"),
    **_affinity_tables(),
    "cohorts": (
        "SELECT subject_id, max(c = 'predicted') AS predicted, max(c = 'martin') AS martin, "
        "max(c = 'angus') AS angus, max(c = 'explicit') AS explicit FROM ("
        "SELECT subject_id, 'predicted' AS c FROM septic "
        "UNION ALL SELECT user_id, 'martin' FROM events WHERE event_type = 'purchase' AND value > 150 "
        "UNION ALL SELECT user_id, 'angus' FROM events WHERE event_type = 'error' AND value > 180 "
        "UNION ALL SELECT user_id, 'explicit' FROM events WHERE event_type = 'view' AND value > 200) "
        "GROUP BY subject_id",
        ("septic",),
    ),
    "raw_means": (
        "SELECT c.subject_id, c.charttime AS raw_time, c.itemid, avg(valuenum) AS avg_value FROM chart c JOIN d_items d "
        f"ON c.itemid = d.itemid WHERE c.itemid IN {_in(items.OLDER_SYSTEM)} "
        f"AND c.subject_id NOT IN {_in(items.OLDER_SYSTEM_EXCLUDED_SUBJECTS)} GROUP BY ALL",
        ("chart", "d_items"),
    ),
}

_TABLES = {**SQL_TABLES, **EXTRA}


def _sql(body: str, *tables: str) -> str:
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in ordered:
            return
        for n in _TABLES[name][1]:
            need(n)
        ordered.append(name)

    for t in tables:
        need(t)
    if not ordered:
        return body
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({_TABLES[n][0]})" for n in ordered) + " " + body


def _round(columns: Sequence[str], places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in columns)


def _item_means(ids: Sequence[int], means: str = "means") -> str:
    known = f"itemid IN {_in(ids)} AND itemid IN (SELECT itemid FROM d_items)"
    return _sql(
        f"SELECT {_STAY_HOUR}, itemid, round(avg_value, 6) AS avg_value FROM {means} WHERE {known}",
        means, "d_items",
    )


def _folded(ladder: Sequence[int], with_item: bool = True, temperature: bool = False) -> str:
    inner = _ladder(ladder, "value", with_item, temperature)
    columns = _STAY_HOUR + (", itemid" if with_item else "")
    return _sql(f"SELECT {columns}, round(value, 6) AS value FROM ({inner})", "means")


def _hash(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


_DRAW = f"{_hash('CAST(subject_id AS VARCHAR) || $$:8803$$')} < {SAMPLE_RATE} * 4294967296.0"
_MATRIX_VITALS = ("bp_dia", "bp_sys", "heart_rate", "resp_rate", "temp_f", "spo2")
_matrix_columns = f"{_STAY_HOUR}, label, {_round((*_MATRIX_VITALS, 'gcs'))}, age"
_filled_columns = f"{_STAY_HOUR}, {_round(VITALS)}, CAST(age AS DOUBLE) AS age"

_pair_names = [
    (a, b)
    for i, a in enumerate(("predicted", "martin", "angus", "explicit"))
    for b in ("predicted", "martin", "angus", "explicit")[i + 1 :]
]


def _share(a: str, b: str) -> str:
    def over(cond: str) -> str:
        return f"round(count(*) FILTER ({cond}) / nullif(count(*) FILTER ({a} OR {b}), 0)::DOUBLE, 6)"

    return (
        f"SELECT '{a}' AS left_cohort, '{b}' AS right_cohort, {over(f'{a} AND {b}')} AS both_share, "
        f"{over(f'{a} AND NOT {b}')} AS left_share, {over(f'{b} AND NOT {a}')} AS right_share FROM cohorts"
    )


def _mixture() -> str:
    parts = []
    for w, m, v in zip(MIXTURE.weights, MIXTURE.means, MIXTURE.variances):
        parts.append(f"{w!r} / sqrt(2 * pi() * {v!r}) * exp(-(value - {m!r}) * (value - {m!r}) / (2 * {v!r}))")
    whole = " + ".join(parts)
    rows = []
    for c, (part, m) in enumerate(zip(parts, MIXTURE.means)):
        r = f"weight * ({part}) / ({whole})"
        rows.append(
            f"SELECT {c} AS component, round(sum({r}) / sum(weight), 4) AS weight, "
            f"round(sum({r} * value) / sum({r}), 4) AS mean, "
            f"round(sum({r} * (value - {m!r}) * (value - {m!r})) / sum({r}), 4) AS variance FROM weighted_events"
        )
    return " UNION ALL ".join(rows)


_log_path = (
    f"CASE WHEN state = 0 THEN ln({_density(REAL_MODEL, 'obs', 0)}) ELSE ln({_density(REAL_MODEL, 'obs', 1)}) END"
)
_a_real = _a(REAL_MODEL)
_moves = (
    f"CASE WHEN before IS NULL THEN CASE WHEN state = 0 THEN ln({REAL_MODEL.initial[0]}) ELSE ln({REAL_MODEL.initial[1]}) END "
    f"WHEN before = 0 AND state = 0 THEN ln({_a_real['a00']}) WHEN before = 0 THEN ln({_a_real['a01']}) "
    f"WHEN state = 0 THEN ln({_a_real['a10']}) ELSE ln({_a_real['a11']}) END"
)
_vec = "unnest(embedding) AS v, unnest(range(0, len(embedding))) AS i"
_LAST = "QUALIFY row_number() OVER (PARTITION BY seq_id ORDER BY n DESC) = 1"

ORACLE: dict[str, str] = {
    "bp_dia_hourly": _folded(items.DIASTOLIC),
    "bp_sys_hourly": _folded(items.SYSTOLIC),
    "eye_hourly": _folded(items.EYE),
    "eye3_hourly": _folded(items.EYE_WIDE),
    "verbal_hourly": _folded(items.VERBAL),
    "motor_hourly": _folded(items.MOTOR),
    "temp_hourly": _folded(items.TEMPERATURE, temperature=True),
    "single_feature": _folded((items.HEART_RATE,), with_item=False),
    "item_hourly_mean": _item_means(items.EASY_VITALS),
    "bp_item_hourly_mean": _item_means(items.SYSTOLIC, "means_all"),
    "gcs_item_hourly_mean": _item_means(items.GCS_REGULAR),
    "apache2_item_hourly_mean": _item_means(items.GCS_APACHE2),
    "apache4_item_hourly_mean": _item_means(items.GCS_APACHE4),
    "temp_item_hourly_mean": _item_means(items.TEMPERATURE),
    "item_raw_mean": _sql(
        "SELECT subject_id, date_trunc('hour', raw_time) AS charttime, itemid, round(avg_value, 6) AS avg_value "
        "FROM raw_means WHERE avg_value IS NOT NULL",
        "raw_means",
    ),
    "top_rows": _sql(
        "SELECT subject_id, date_trunc('hour', raw_time) AS charttime, itemid, round(avg_value, 6) AS avg_value "
        "FROM raw_means WHERE avg_value IS NOT NULL "
        "ORDER BY subject_id, charttime, itemid, round(avg_value, 6) LIMIT 1000000",
        "raw_means",
    ),
    "labelled_raw_mean": _sql(
        "SELECT subject_id, date_trunc('hour', raw_time) AS charttime, item_desc, round(avg_value, 6) AS avg_value FROM ("
        "SELECT c.subject_id, c.charttime AS raw_time, d.label AS item_desc, avg(valuenum) AS avg_value "
        f"FROM chart c JOIN d_items d ON c.itemid = d.itemid WHERE c.itemid IN {_in(items.LONG_FORM)} GROUP BY ALL)",
        "chart", "d_items",
    ),
    "first_raw_readings": _sql(
        "SELECT subject_id, icustay_id, charttime, "
        f"CAST(arg_min(itemid, list_position({_list(items.DIASTOLIC)}, itemid)) AS INTEGER) AS itemid, "
        f"round(arg_min(m, list_position({_list(items.DIASTOLIC)}, itemid)), 6) AS value FROM ("
        "SELECT c.subject_id, a.icustay_id, c.charttime, c.itemid, avg(valuenum) AS m FROM chart c JOIN d_items d ON c.itemid = d.itemid JOIN adults a "
        "ON c.subject_id = a.subject_id AND c.charttime BETWEEN a.intime AND a.outtime "
        f"WHERE c.itemid IN {_in(items.DIASTOLIC)} GROUP BY ALL"
        ") WHERE m != 0 GROUP BY 1, 2, 3",
        "chart", "adults", "d_items",
    ),
    "adult_stays": _sql(
        "SELECT subject_id, icustay_id, intime, outtime, dbsource, round(age, 6) AS age FROM adults", "adults"
    ),
    "stay_bounds": _sql("SELECT * FROM bounds", "bounds"),
    "older_stay_bounds": _sql(
        "SELECT subject_id, icustay_id, date_trunc('hour', intime) AS intime, "
        "date_trunc('hour', outtime + INTERVAL 30 MINUTE) AS outtime FROM stays WHERE dbsource = 'carevue' "
        f"AND subject_id NOT IN {_in(items.OLDER_SYSTEM_EXCLUDED_SUBJECTS)}",
        "stays",
    ),
    "wide_features": _sql(f"SELECT {_STAY_HOUR}, {_round(VITALS)}, age FROM wide", "wide"),
    "temp_cf_full_join": _sql(
        "SELECT coalesce(c.icustay_id, f.icustay_id) AS icustay_id, coalesce(c.charttime, f.charttime) AS charttime, "
        "c.subject_id::DOUBLE AS c_subject_id, round(c.v, 6) AS temp_c, f.subject_id::DOUBLE AS f_subject_id, round(f.v, 6) AS temp_f "
        f"FROM (SELECT {_STAY_HOUR}, avg(valuenum) AS v FROM matched WHERE itemid = 223762 GROUP BY ALL) c "
        f"FULL JOIN (SELECT {_STAY_HOUR}, avg(valuenum) AS v FROM matched WHERE itemid = 223761 GROUP BY ALL) f "
        "ON c.icustay_id = f.icustay_id AND c.charttime = f.charttime",
        "matched",
    ),
    "hourly_grid": _sql("SELECT * FROM grid", "grid"),
    "grid_features": _sql(f"SELECT {_STAY_HOUR}, {_round(VITALS)}, age::DOUBLE AS age FROM grid_wide", "grid_wide"),
    "grid_labels": _sql(
        "SELECT g.*, CASE WHEN o.icustay_id IS NULL THEN 0 ELSE 1 END AS label FROM grid g LEFT JOIN onsets o "
        "ON g.subject_id = o.subject_id AND g.icustay_id = o.icustay_id AND g.charttime = o.charttime",
        "grid", "onsets",
    ),
    "fill_forward": _sql(f"SELECT {_filled_columns} FROM forward", "forward"),
    "fill_both": _sql(f"SELECT {_filled_columns} FROM filled", "filled"),
    "labelled_matrix": _sql(f"SELECT {_matrix_columns} FROM matrix", "matrix"),
    "unlabelled_matrix": _sql(
        f"SELECT {_STAY_HOUR}, 0 AS label, {_round((*_MATRIX_VITALS, 'gcs'))}, age FROM matrix", "matrix"
    ),
    "sampled_matrix": _sql(
        f"SELECT {_matrix_columns} FROM matrix WHERE subject_id IN (SELECT subject_id FROM stays WHERE {_DRAW})", "matrix", "stays"
    ),
    "infection_pairs": _sql("SELECT * FROM windows", "windows"),
    "score_windows": _sql(
        "SELECT subject_id, charttime, starttime, max(score) AS max_score, min(score) AS min_score, "
        "max(rise) AS rise FROM window_scores GROUP BY ALL",
        "window_scores",
    ),
    "score_max_rise": _sql(
        "SELECT subject_id, icustay_id, list_reduce(list({'low': score, 'rise': 0} ORDER BY starttime, score), "
        "lambda s, v: {'low': least(s.low, v.low), 'rise': greatest(s.rise, v.low - s.low)}, "
        "{'low': 99, 'rise': 0}).rise AS rise, max(score) AS max_score, min(score) AS min_score "
        "FROM scores GROUP BY subject_id, icustay_id",
        "scores",
    ),
    "onset_by_subject": _sql("SELECT * FROM septic", "septic"),
    "onset_by_stay": _sql("SELECT * FROM onsets", "onsets"),
    "stay_scores": _sql(
        "SELECT s.subject_id, s.icustay_id, c.starttime, c.score FROM stays s JOIN scores c "
        "ON s.icustay_id = c.icustay_id",
        "stays", "scores",
    ),
    "item_counts": _sql(
        "SELECT c.itemid, d.label, count(*) AS n FROM chart c JOIN d_items d ON c.itemid = d.itemid GROUP BY ALL",
        "chart", "d_items",
    ),
    "flag_counts": (
        "SELECT l_suppkey AS subject_id, l_partkey AS itemid, l_returnflag AS flag, p_name AS label, count(*) AS n "
        "FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"
    ),
    "drug_counts": "SELECT p_name AS drug, count(*) AS n FROM part WHERE p_name LIKE '%gear%' GROUP BY ALL",
    "label_search": _sql("SELECT * FROM drug_items WHERE label LIKE '%bolt%'", "drug_items"),
    "subject_slice": _sql("SELECT * FROM cultures WHERE subject_id = 64", "cultures"),
    "code_range_counts": (
        "SELECT l_suppkey AS subject_id, CAST(l_quantity AS INTEGER) AS code, n_name AS section, count(*) AS n "
        "FROM lineitem JOIN nation ON CAST(l_quantity AS INTEGER) < n_nationkey * 2 + 4 "
        "AND CAST(l_quantity AS INTEGER) > n_nationkey * 2 GROUP BY ALL"
    ),
    "cohort_overlap": _sql(" UNION ALL ".join(_share(a, b) for a, b in _pair_names), "cohorts"),
    "common_scores": _sql(
        "SELECT * FROM scores WHERE subject_id IN (SELECT subject_id FROM inputs) AND subject_id IN (SELECT subject_id FROM cultures)",
        "scores", "inputs", "cultures",
    ),
    "common_patients": _sql(
        "SELECT subject_id FROM inputs INTERSECT SELECT subject_id FROM cultures INTERSECT SELECT subject_id FROM scores",
        "inputs", "cultures", "scores",
    ),
    "non_septic": _sql(
        "SELECT DISTINCT subject_id FROM stays WHERE subject_id NOT IN (SELECT subject_id FROM onsets)",
        "stays", "onsets",
    ),
    "stay_label": _sql(
        "SELECT icustay_id, arg_max(label, charttime) AS label FROM matrix GROUP BY icustay_id", "matrix"
    ),
    "stay_lengths": _sql(
        "SELECT icustay_id, count(*) AS n_hours FROM matrix GROUP BY icustay_id HAVING count(*) >= 7", "matrix"
    ),
    "stay_sequence_lengths": _sql(
        "SELECT icustay_id, CAST(count(*) AS INTEGER) AS length FROM matrix GROUP BY icustay_id", "matrix"
    ),
    "sequence_index": (
        "SELECT user_id AS seq_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx "
        "FROM events"
    ),
    "sample_patients": _sql(f"SELECT DISTINCT subject_id FROM stays WHERE {_DRAW}", "stays"),
    "sample_strata": _sql(
        f"SELECT subject_id, 1 AS septic FROM (SELECT DISTINCT subject_id FROM onsets) WHERE {_DRAW} UNION ALL "
        "SELECT DISTINCT s.subject_id, 0 FROM stays s, "
        "(SELECT count(*)::DOUBLE AS n FROM stays WHERE subject_id NOT IN (SELECT subject_id FROM onsets)) a, "
        f"(SELECT count(*)::DOUBLE AS k FROM (SELECT DISTINCT subject_id FROM onsets) WHERE {_DRAW}) b "
        "WHERE s.subject_id NOT IN (SELECT subject_id FROM onsets) AND "
        + _hash("CAST(s.subject_id AS VARCHAR) || ':' || CAST(s.icustay_id AS VARCHAR) || ':8803'")
        + f" < greatest((n * {SAMPLE_RATE} - k) / n, 0) * 4294967296.0",
        "stays", "onsets",
    ),
    "stratum_counts": _sql(
        "SELECT 'septic' AS stratum, count(DISTINCT subject_id) AS n FROM onsets UNION ALL "
        "SELECT 'non_septic', count(*) FROM stays WHERE subject_id NOT IN (SELECT subject_id FROM onsets)",
        "stays", "onsets",
    ),
    "sampled_scores": _sql(f"SELECT * FROM scores WHERE {_DRAW}", "scores"),
    "split_sequences": _sql(
        "SELECT file, icustay_id, CASE WHEN row_number() OVER (PARTITION BY file ORDER BY h, icustay_id) "
        "<= round_even(count(*) OVER (PARTITION BY file) * 0.75, 0) THEN 'train' ELSE 'test' END AS part FROM ("
        f"SELECT icustay_id % 100 AS file, icustay_id, {_hash('CAST(icustay_id AS VARCHAR) || $$:8803$$')} AS h FROM stays)",
        "stays",
    ),
    "graph_vertices": _sql(
        "SELECT 'patient' AS kind, CAST(c_custkey AS VARCHAR) AS name FROM customer UNION "
        "SELECT DISTINCT kind, code FROM graph_facts",
        "graph_facts",
    ),
    "graph_edges": _sql(
        "SELECT 'patient' AS src_kind, CAST(patient_id AS VARCHAR) AS src, kind AS dst_kind, code AS dst, "
        "kind AS edge_kind, max(date) AS date FROM graph_facts GROUP BY patient_id, kind, code UNION ALL "
        "SELECT kind, code, 'patient', CAST(patient_id AS VARCHAR), kind, max(date) FROM graph_facts "
        "GROUP BY patient_id, kind, code",
        "graph_facts",
    ),
    "jaccard_all": _sql(
        "SELECT patient_a, patient_b, round(similarity, 6) AS similarity FROM ("
        "SELECT p.patient_a, p.patient_b, k / (a.n + b.n - k)::DOUBLE AS similarity FROM ("
        "SELECT x.patient_id AS patient_a, y.patient_id AS patient_b, count(*) AS k FROM held x JOIN held y "
        "ON x.code = y.code AND x.patient_id < y.patient_id GROUP BY ALL) p "
        "JOIN sizes a ON a.patient_id = patient_a JOIN sizes b ON b.patient_id = patient_b) "
        f"WHERE similarity >= {SIMILAR} - 1e-12",
        "held", "sizes",
    ),
    "jaccard_top10": _top_similar("held", "sizes"),
    "jaccard_top10_kinds": _top_similar("kinds_held", "kinds_sizes"),
    "random_walk": _walk("held", f"walk_{WALK_STEPS // 2}"),
    "random_walk_kinds": _walk("kinds_held", f"kinds_walk_{WALK_STEPS // 2}"),
    "code_affinity": _sql("SELECT a AS patient_id, round(v, 6) AS value FROM affinity_2", "affinity_2"),
    "baum_welch_step": _sql(_round_of_training(), "gammas", "steps"),
    "transition_counts": _sql(
        "SELECT state, next_state, count(*) AS n FROM (SELECT state, lead(state) OVER (PARTITION BY seq_id ORDER BY t) "
        "AS next_state FROM labelled_steps) WHERE next_state IS NOT NULL GROUP BY ALL",
        "labelled_steps",
    ),
    "initial_states": _sql(
        "SELECT state, count(*) AS n FROM (SELECT arg_min(state, t) AS state FROM labelled_steps GROUP BY seq_id) GROUP BY ALL",
        "labelled_steps",
    ),
    "fit_integer": _sql(
        "SELECT state, level AS value, round(sum(weight) / any_value(whole), 6) AS probability FROM weighted_events "
        "JOIN (SELECT state, sum(weight) AS whole FROM weighted_events GROUP BY state) USING (state) "
        "GROUP BY state, level",
        "weighted_events",
    ),
    "fit_gaussian": _sql(
        "SELECT state, round(any_value(m), 4) AS mean, "
        "round(sum(weight * (value - m) * (value - m)) / sum(weight), 4) AS variance FROM weighted_events "
        "JOIN (SELECT state, sum(weight * value) / sum(weight) AS m FROM weighted_events GROUP BY state) "
        "USING (state) GROUP BY state",
        "weighted_events",
    ),
    "fit_multi": (
        f"WITH x AS (SELECT vec_id, label, {_vec} FROM embeddings), m AS ("
        "SELECT label, i, avg(v::DOUBLE) AS m FROM x GROUP BY ALL) "
        "SELECT a.label::BIGINT AS state, a.i::INTEGER AS i, b.i::INTEGER AS j, round(any_value(p.m), 6) AS mean_i, "
        "round(any_value(q.m), 6) AS mean_j, round(avg((a.v::DOUBLE - p.m) * (b.v::DOUBLE - q.m)), 6) AS covariance "
        "FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.i <= b.i "
        "JOIN m p ON p.label = a.label AND p.i = a.i JOIN m q ON q.label = b.label AND q.i = b.i "
        "GROUP BY a.label, a.i, b.i"
    ),
    "fit_mixture_step": _sql(_mixture(), "weighted_events"),
    "vector_arithmetic": (
        f"WITH x AS (SELECT vec_id, label, {_vec} FROM embeddings), m AS ("
        "SELECT label, i, avg(v::DOUBLE) AS m FROM x GROUP BY ALL) "
        "SELECT vec_id, round(sqrt(sum((v::DOUBLE - m) * (v::DOUBLE - m))), 6) AS distance, "
        "round(sum(v::DOUBLE + m), 6) AS added, round(sum(v::DOUBLE - m), 6) AS subtracted, "
        "round(sum(v::DOUBLE * 2.5), 6) AS scaled FROM x JOIN m USING (label, i) GROUP BY vec_id"
    ),
    "seq_loglik": _sql(
        f"SELECT seq_id, n AS n_steps, round(ll, 6) AS log_likelihood FROM fwd {_LAST}", "fwd"
    ),
    "seq_probability": _sql(
        "SELECT seq_id, CASE WHEN exp(ll) > 0 THEN round(ln(exp(ll)), 6) END AS probability "
        f"FROM (SELECT * FROM type_fwd {_LAST})",
        "type_fwd",
    ),
    "path_loglik": _sql(
        f"SELECT seq_id, round(sum({_log_path} + {_moves}), 6) AS log_probability FROM ("
        "SELECT *, lag(state) OVER (PARTITION BY seq_id ORDER BY t) AS before FROM labelled_steps) GROUP BY seq_id",
        "labelled_steps",
    ),
    "viterbi_path": _sql(
        "SELECT p.seq_id, o.t, p.state, round(p.lp, 6) AS path_log_probability FROM path p JOIN observed o "
        "ON o.seq_id = p.seq_id AND o.n = p.n",
        "path",
    ),
    "posterior": _sql(f"SELECT seq_id, t, {_round(('p0', 'p1'))} FROM gammas", "gammas"),
    "posterior_mass": _sql(
        "SELECT 0 AS state, round(sum(p0), 4) AS mass FROM gammas UNION ALL SELECT 1, round(sum(p1), 4) FROM gammas",
        "gammas",
    ),
    "model_gap": _sql(
        f"SELECT round(avg((a.ll - b.ll) / a.n), 6) AS gap FROM (SELECT * FROM fwd {_LAST}) a "
        f"JOIN (SELECT * FROM other_fwd {_LAST}) b ON a.seq_id = b.seq_id",
        "fwd", "other_fwd",
    ),
    "kmeans": """
        WITH RECURSIVE points AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        seeds AS (SELECT x, min(vec_id) AS v FROM points GROUP BY x ORDER BY v LIMIT 10),
        state AS (
            SELECT 0 AS round, list(x ORDER BY v) AS centres, false AS still FROM seeds
            UNION ALL
            SELECT round + 1, moved, list_max(flatten(list_transform(range(1, len(moved) + 1), lambda j:
                list_transform(range(1, len(moved[j]) + 1), lambda i: abs(moved[j][i] - centres[j][i]))))) <= 1e-9
            FROM (SELECT round, centres, list_transform(range(1, len(centres) + 1), lambda j: coalesce(means[j], centres[j])) AS moved FROM (
                SELECT any_value(round) AS round, any_value(centres) AS centres, map_from_entries(list((k, x))) AS means FROM (
                    SELECT any_value(round) AS round, any_value(centres) AS centres, k, list(m ORDER BY i) AS x FROM (
                        SELECT any_value(round) AS round, any_value(centres) AS centres, k, i, avg(x[i]) AS m FROM (
                            SELECT round, centres, x, unnest(range(1, len(x) + 1)) AS i, list_position(d, list_min(d)) AS k FROM (
                                SELECT round, centres, x, list_transform(centres, lambda c: list_distance(c, x)) AS d
                                FROM state, points WHERE NOT still AND round < 100))
                        GROUP BY k, i) GROUP BY k)) WHERE round IS NOT NULL)),
        last AS (SELECT centres FROM state ORDER BY round DESC LIMIT 1)
        SELECT vec_id, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster FROM (
            SELECT vec_id, list_transform(centres, lambda c: list_distance(c, x)) AS d FROM last, points)
    """,
    "read_wide_rows": _sql(f"SELECT {_STAY_HOUR}, {_round(VITALS)}, age FROM wide WHERE charttime IS NOT NULL", "wide"),
    "read_stay_rows": _sql(
        "SELECT subject_id, icustay_id, date_trunc('second', intime) AS intime, date_trunc('second', outtime) AS outtime FROM stays "
        "WHERE icustay_id % 13 <> 0 AND icustay_id % 17 <> 0 AND icustay_id % 11 <> 0",
        "stays",
    ),
    "read_stay_rejects": _sql(
        "SELECT CASE WHEN icustay_id % 13 = 0 OR icustay_id % 17 = 0 THEN 'malformed' ELSE 'missing intime' END AS reason, count(*) AS n "
        "FROM stays WHERE icustay_id % 13 = 0 OR icustay_id % 17 = 0 OR icustay_id % 11 = 0 GROUP BY ALL",
        "stays",
    ),
    "read_label_rows": _sql("SELECT subject_id, icustay_id, date_trunc('second', charttime) AS charttime FROM onsets WHERE subject_id % 5 <> 0", "onsets"),
    "read_chart_rows": _sql(
        "SELECT subject_id, date_trunc('second', charttime) AS charttime, CAST(itemid AS BIGINT) AS itemid, round(valuenum, 6) AS avg_value "
        "FROM chart WHERE itemid NOT IN (211, 618)",
        "chart",
    ),
    "read_chart_rejects": _sql(
        "SELECT CASE WHEN itemid = 211 THEN 'malformed' ELSE 'missing charttime' END AS reason, count(*) AS n "
        "FROM chart WHERE itemid IN (211, 618) GROUP BY ALL",
        "chart",
    ),
    "read_cohort_rows": "SELECT DISTINCT user_id AS subject_id FROM events WHERE user_id % 7 > 1",
    "parse_tuples": _sql(
        f"SELECT icustay_id, charttime, label, {_round((*_MATRIX_VITALS, 'gcs'))}, age FROM matrix", "matrix"
    ),
    "parse_matrix": _sql(
        "SELECT icustay_id::DOUBLE AS icustay_id, "
        + _round(SEQUENCE_COLUMNS[:-1])
        + ", age::DOUBLE AS age FROM matrix",
        "matrix",
    ),
    "parse_sequences": _sql(
        "SELECT icustay_id AS seq_id, CAST(row_number() OVER (PARTITION BY icustay_id ORDER BY charttime) - 1 AS INTEGER) AS t, "
        + _round(SEQUENCE_COLUMNS[:-1])
        + ", age::DOUBLE AS age FROM matrix QUALIFY count(*) OVER (PARTITION BY icustay_id) >= 7",
        "matrix",
    ),
    "parse_posteriors": _sql(
        "SELECT seq_id, CAST(t - epoch_us(TIMESTAMP '2024-01-01') // 3600000000 AS INTEGER) AS t, "
        f"{_round(('p0', 'p1'))} FROM gammas",
        "gammas",
    ),
    "parse_scalars": _sql(
        "SELECT seq_id, CAST(row_number() OVER (PARTITION BY seq_id ORDER BY t) - 1 AS INTEGER) AS t, "
        "round(obs, 6) AS obs FROM steps",
        "steps",
    ),
    "parse_bracketed": _sql(
        "SELECT icustay_id AS seq_id, CAST(row_number() OVER (PARTITION BY icustay_id ORDER BY charttime) - 1 AS INTEGER) AS t, "
        + _round(SEQUENCE_COLUMNS[:-1])
        + ", age::DOUBLE AS age FROM matrix",
        "matrix",
    ),
}
