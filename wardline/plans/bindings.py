"""Clinical tables derived from the benchmark's event, part and order tables.

Each binding exists twice with the same rule: as a DataFrame, and as SQL for the oracle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.clock import hour_number
from wardline.functions.items import CULTURE_SPECIMENS
from wardline.operators import onset
from wardline.operators.features import wide_features
from wardline.operators.grid import labelled_matrix
from wardline.operators.sampling import keep_subjects
from wardline.operators.stays import adult_stays, stay_bounds
from wardline.session import use_utc

# Every event is charted under the items of its type; the reading is shifted by the item id.
TYPE_ITEMS = {
    "click": (220180, 220179, 220045, 226756, 211, 8368),
    "error": (220051, 220050, 220060, 220059, 220210, 227011, 227012, 646),
    "purchase": (225310, 225309, 223761, 220277, 227014, 228112, 618),
    "signup": (224643, 224167, 220739, 223900, 223901, 678, 442),
    "view": (227242, 228151, 227243, 228152, 223762, 226758, 226757, 51),
}
TYPES = tuple(TYPE_ITEMS)
ALL_ITEMS = tuple(i for items in TYPE_ITEMS.values() for i in items)
STAY_DAYS = 5
SHIFTED_EVERY = 37


def _stay_id() -> Column:
    block = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / STAY_DAYS)
    return (F.col("user_id") * 100 + block).cast("long")


@dataclass
class Ward:
    """The domain tables over one data folder."""

    spark: SparkSession
    folder: str

    def __post_init__(self):
        use_utc(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def chart(self) -> DataFrame:
        # Events are kept once and their items exploded; only the item filter decides what survives.
        items = F.coalesce(
            *[
                F.when(F.col("event_type") == t, F.array(*[F.lit(i).cast("int") for i in ids]))
                for t, ids in TYPE_ITEMS.items()
            ]
        )
        rows = self.events.select(
            F.col("user_id").alias("subject_id"), F.col("ts").alias("charttime"), "value",
            F.explode(items).alias("itemid"),
        )
        return rows.select(
            "subject_id", "charttime", "itemid",
            (F.col("value") + (F.col("itemid") % 10) * 0.5).alias("valuenum"),
        )

    @cached_property
    def stays(self) -> DataFrame:
        return (
            self.events.groupBy(F.col("user_id").alias("subject_id"), _stay_id().alias("icustay_id"))
            .agg(F.min("ts").alias("intime"), F.max("ts").alias("outtime"))
            .withColumn(
                "dbsource",
                F.when(F.col("subject_id") % 5 == 0, F.lit("carevue")).otherwise(F.lit("metavision")),
            )
        )

    @cached_property
    def patients(self) -> DataFrame:
        years = F.when(F.col("subject_id") % SHIFTED_EVERY == 0, F.lit(300)).otherwise(
            F.col("subject_id") * 7 % 100
        )
        return (
            self.events.select(F.col("user_id").alias("subject_id")).distinct()
            .withColumn("_days", (years * 366).cast("int"))
            .select(
                "subject_id",
                F.expr("timestamp_ntz'2024-01-01' - make_dt_interval(_days)").alias("dob"),
            )
        )

    @cached_property
    def adults(self) -> DataFrame:
        return adult_stays(self.stays, self.patients)

    @cached_property
    def d_items(self) -> DataFrame:
        """Item dictionary over parts: all charted items are spread over the first part keys.

        The charted items are at most ALL_ITEMS, so these are broadcast; the planner would take the parts, by their packed size.
        """
        position = F.array_position(F.array(*[F.lit(i) for i in ALL_ITEMS]), F.col("itemid"))
        return self.table("part").select("p_partkey", "p_name", "p_type").join(
            F.broadcast(self._chart_items.withColumn("_key", position - 1)),
            F.col("_key") == F.col("p_partkey"),
        ).select("itemid", F.col("p_name").alias("label"), F.col("p_type").alias("category"))

    @cached_property
    def _chart_items(self) -> DataFrame:
        return self.chart.select("itemid").distinct()

    @cached_property
    def drug_items(self) -> DataFrame:
        """Dictionary of inputs: parts, where small ones are antibiotics."""
        category = F.when(F.col("p_size") <= 40, F.lit("Antibiotics")).otherwise(F.lit("Other"))
        return self.table("part").select(
            F.col("p_partkey").alias("itemid"), F.col("p_name").alias("label"), category.alias("category")
        )

    @cached_property
    def inputs(self) -> DataFrame:
        """Purchases; the item is drawn from the part keys by the event's id."""
        return self.events.where(F.col("event_type") == "purchase").select(
            F.col("user_id").alias("subject_id"), _stay_id().alias("icustay_id"),
            (F.col("event_id") % 200).alias("itemid"), F.col("ts").alias("starttime"),
        )

    @cached_property
    def cultures(self) -> DataFrame:
        """Errors; a reading below 5 has no organism, one specimen in nine is not a listed one."""
        specimens = F.array(*[F.lit(s) for s in (*CULTURE_SPECIMENS, 70001)])
        return self.events.where(F.col("event_type") == "error").select(
            F.col("user_id").alias("subject_id"), F.col("ts").alias("charttime"),
            F.get(specimens, (F.col("event_id") % 9).cast("int")).alias("spec_itemid"),
            F.when(F.col("value") >= 5, F.col("props")).alias("org_name"),
        )

    @cached_property
    def scores(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "signup").select(
            F.col("user_id").alias("subject_id"), _stay_id().alias("icustay_id"),
            F.col("ts").alias("starttime"), F.floor(F.col("value") / 20).cast("int").alias("score"),
        )

    @cached_property
    def facts(self) -> DataFrame:
        """Dated codes of the graph: customers hold the parts they ordered."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("patient_id"), F.lit("diagnosis").alias("kind"),
            F.col("l_partkey").alias("code"), F.col("o_orderdate").alias("date"),
        )

    @cached_property
    def graph_patients(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("patient_id"))

    @cached_property
    def graph_facts(self) -> DataFrame:
        """All three kinds of codes: part, brand as medication, type as laboratory test."""
        part = self.table("part").select("p_partkey", "p_brand", "p_type")
        rows = self.facts.join(part, F.col("code") == F.col("p_partkey"))
        code = F.array(
            F.struct(F.lit("diagnosis").alias("kind"), F.col("code").cast("string").alias("code")),
            F.struct(F.lit("medication").alias("kind"), F.col("p_brand").alias("code")),
            F.struct(F.lit("lab").alias("kind"), F.col("p_type").alias("code")),
        )
        return rows.select("patient_id", "date", F.inline(code))

    @cached_property
    def steps(self) -> DataFrame:
        """Hourly sequence per user: mean reading of each hour; ``t`` counts hours."""
        return (
            self.events.groupBy(F.col("user_id").alias("seq_id"), hour_number(F.col("ts")).alias("t"))
            .agg(F.avg("value").alias("obs"))
        )

    @cached_property
    def type_steps(self) -> DataFrame:
        """Hourly sequence per user: type of the hour's last event as an integer."""
        types = F.array(*[F.lit(t) for t in TYPES])
        last = F.max_by("event_type", F.struct("ts", "event_id"))
        return (
            self.events.groupBy(F.col("user_id").alias("seq_id"), hour_number(F.col("ts")).alias("t"))
            .agg((F.array_position(types, last) - 1).cast("int").alias("obs"))
        )

    @cached_property
    def labelled_steps(self) -> DataFrame:
        """Hourly readings with a known state: 1 at 40 and above."""
        return self.steps.withColumn("state", (F.col("obs") >= 40).cast("int"))

    @cached_property
    def weighted_events(self) -> DataFrame:
        """Readings by event type, with a weight, as emission samples."""
        types = F.array(*[F.lit(t) for t in TYPES])
        return self.events.select(
            (F.array_position(types, F.col("event_type")) - 1).cast("int").alias("state"),
            F.col("value"),
            F.floor(F.col("value") / 20).cast("int").alias("level"),
            (F.lit(1.0) + (F.col("event_id") % 4) * 0.25).alias("weight"),
        )

    @cached_property
    def features(self) -> DataFrame:
        return wide_features(self.chart, self.adults, d_items=self.d_items)

    @cached_property
    def bounds(self) -> DataFrame:
        return stay_bounds(self.stays.where(F.col("dbsource") == "metavision"))

    @cached_property
    def windows(self) -> DataFrame:
        return onset.infection_windows(
            onset.antibiotic_starts(self.inputs, self.drug_items), onset.suspected_cultures(self.cultures)
        )

    @cached_property
    def stay_windows(self) -> DataFrame:
        return onset.infection_windows(
            onset.antibiotic_starts(self.inputs, self.drug_items, self.stays),
            onset.suspected_cultures(self.cultures),
            ("subject_id", "icustay_id"),
        )

    @cached_property
    def adult_scores(self) -> DataFrame:
        return self.scores.join(
            self.adults.select("subject_id", "icustay_id"), ["subject_id", "icustay_id"], "left_semi"
        )

    @cached_property
    def labels(self) -> DataFrame:
        return onset.onset(self.stay_windows, self.adult_scores, ("subject_id", "icustay_id"))

    @cached_property
    def matrix(self) -> DataFrame:
        return labelled_matrix(self.features, self.bounds, self.labels)

    def restricted(self, subjects: DataFrame) -> "Ward":
        """The same tables for some subjects only, filtered where they are read: all that is derived from them is small too."""
        out = Ward(self.spark, self.folder)
        for name in ("chart", "stays", "patients", "inputs", "cultures", "scores"):
            setattr(out, name, keep_subjects(getattr(self, name), subjects))
        return out


def _sql_items() -> str:
    arms = " ".join(
        f"WHEN event_type = '{t}' THEN [{', '.join(map(str, ids))}]" for t, ids in TYPE_ITEMS.items()
    )
    return f"CASE {arms} END"


_STAY = (
    "user_id * 100 + CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / "
    f"{STAY_DAYS}.0) AS BIGINT)"
)
_AGE = "date_diff('microsecond', dob, intime) / 1000000.0 / 60.0 / 60.0 / 24.0 / 365.242"
_TYPES = "[" + ", ".join(f"'{t}'" for t in TYPES) + "]"

# Name -> (SQL body, names it reads). Times are TIMESTAMP without zone.
SQL_TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "chart": (
        "SELECT subject_id, charttime, itemid, value + (itemid % 10) * 0.5 AS valuenum FROM ("
        "SELECT user_id AS subject_id, ts AS charttime, value, "
        f"unnest({_sql_items()}) AS itemid FROM events)",
        (),
    ),
    "stays": (
        f"SELECT user_id AS subject_id, {_STAY} AS icustay_id, min(ts) AS intime, max(ts) AS outtime, "
        "CASE WHEN user_id % 5 = 0 THEN 'carevue' ELSE 'metavision' END AS dbsource "
        "FROM events GROUP BY ALL",
        (),
    ),
    "patients": (
        "SELECT DISTINCT user_id AS subject_id, TIMESTAMP '2024-01-01' - to_days(CAST("
        f"(CASE WHEN user_id % {SHIFTED_EVERY} = 0 THEN 300 ELSE user_id * 7 % 100 END) * 366 AS INTEGER)) AS dob "
        "FROM events",
        (),
    ),
    "adults": (
        f"SELECT s.*, {_AGE} AS age FROM stays s JOIN patients p ON s.subject_id = p.subject_id "
        f"WHERE {_AGE} > 15",
        ("stays", "patients"),
    ),
    "d_items": (
        "SELECT itemid, p_name AS label, p_type AS category FROM "
        f"(SELECT DISTINCT itemid, list_position([{', '.join(map(str, ALL_ITEMS))}], itemid) - 1 AS k FROM chart) c "
        "JOIN part ON p_partkey = k",
        ("chart",),
    ),
    "drug_items": (
        "SELECT p_partkey AS itemid, p_name AS label, "
        "CASE WHEN p_size <= 40 THEN 'Antibiotics' ELSE 'Other' END AS category FROM part",
        (),
    ),
    "inputs": (
        f"SELECT user_id AS subject_id, {_STAY} AS icustay_id, event_id % 200 AS itemid, ts AS starttime "
        "FROM events WHERE event_type = 'purchase'",
        (),
    ),
    "cultures": (
        "SELECT user_id AS subject_id, ts AS charttime, "
        "[70011, 70012, 70060, 70017, 70076, 70070, 70062, 70079, 70001][CAST(event_id % 9 AS INTEGER) + 1] AS spec_itemid, "
        "CASE WHEN value >= 5 THEN props END AS org_name FROM events WHERE event_type = 'error'",
        (),
    ),
    "scores": (
        f"SELECT user_id AS subject_id, {_STAY} AS icustay_id, ts AS starttime, "
        "CAST(floor(value / 20) AS INTEGER) AS score FROM events WHERE event_type = 'signup'",
        (),
    ),
    "facts": (
        "SELECT o_custkey AS patient_id, 'diagnosis' AS kind, l_partkey AS code, o_orderdate AS date "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
        (),
    ),
    "graph_facts": (
        "SELECT patient_id, date, kind, code FROM ("
        "SELECT patient_id, date, 'diagnosis' AS kind, CAST(code AS VARCHAR) AS code FROM facts "
        "UNION ALL SELECT patient_id, date, 'medication', p_brand FROM facts JOIN part ON code = p_partkey "
        "UNION ALL SELECT patient_id, date, 'lab', p_type FROM facts JOIN part ON code = p_partkey)",
        ("facts",),
    ),
    "steps": (
        "SELECT user_id AS seq_id, CAST(epoch_us(date_trunc('hour', ts)) // 3600000000 AS BIGINT) AS t, "
        "avg(value) AS obs FROM events GROUP BY ALL",
        (),
    ),
    "type_steps": (
        "SELECT user_id AS seq_id, CAST(epoch_us(date_trunc('hour', ts)) // 3600000000 AS BIGINT) AS t, "
        f"CAST(list_position({_TYPES}, arg_max(event_type, (ts, event_id))) - 1 AS INTEGER) AS obs "
        "FROM events GROUP BY ALL",
        (),
    ),
    "labelled_steps": ("SELECT *, CAST(obs >= 40 AS INTEGER) AS state FROM steps", ("steps",)),
    "weighted_events": (
        f"SELECT CAST(list_position({_TYPES}, event_type) - 1 AS INTEGER) AS state, value, "
        "CAST(floor(value / 20) AS INTEGER) AS level, 1.0 + (event_id % 4) * 0.25 AS weight FROM events",
        (),
    ),
}
