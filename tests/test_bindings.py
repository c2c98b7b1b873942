"""The derived tables over small folders of their own."""

from __future__ import annotations

from datetime import datetime, timedelta

import __spark_entry__ as entry
import check
from wardline.operators.hmm import train
from wardline.plans.bindings import ALL_ITEMS, TYPES, Ward
from wardline.plans.queries import QUERIES, SEQUENCE_COLUMNS, _matrix_steps

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
PARTS = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def ward(spark, folder):
    """Users with an event of every type each hour; all parts are small."""
    start = datetime(2024, 1, 1, 1)
    rows = []
    for user in (17, 18, 19):
        for hour in range(12):
            for n, kind in enumerate(TYPES):
                rows.append((len(rows), start + timedelta(hours=hour, minutes=n), user, kind, 20.0 + (hour * 7 + n + user) % 60, "p"))
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{folder}/events.parquet")
    parts = [(k, f"part {k}", "brand", "type", 1, 1.0) for k in range(len(ALL_ITEMS) + 4)]
    spark.createDataFrame(parts, PARTS).write.parquet(f"{folder}/part.parquet")
    return Ward(spark, str(folder))


def test_every_charted_item_is_in_the_dictionary_whatever_the_parts_size(spark, tmp_path):
    w = ward(spark, tmp_path)
    assert sorted(r["itemid"] for r in w.d_items.collect()) == sorted(ALL_ITEMS)
    counts = {r["itemid"]: r["n"] for r in QUERIES["item_counts"](w).collect()}
    assert set(counts) == set(ALL_ITEMS) and sum(counts.values()) == w.chart.count()
    readings = QUERIES["bp_dia_hourly"](w).count()
    assert readings == 3 * 12


def test_sql_dictionary_lists_every_charted_item(spark, tmp_path):
    ward(spark, tmp_path)
    con = check.duckdb.connect()
    for t in ("events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = con.execute(entry.oracle_sql()["item_counts"]).fetchall()
    assert {r[0] for r in got} == set(ALL_ITEMS)


def test_matrix_of_the_fits_has_rows_whatever_the_parts_size(spark, tmp_path):
    w = ward(spark, tmp_path)
    assert w.matrix.count() == 3 * 12
    assert QUERIES["elastic_net"](w).count() == 9
    start = train.vector_start(_matrix_steps(w), len(SEQUENCE_COLUMNS))
    assert all(v > 0 for v in start.emissions[0].mean)
