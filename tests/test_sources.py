from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardline.functions.items import VITALS
from wardline.sources import rows, tables, text

T = datetime(2020, 1, 2, 3)


def write(folder, name, body):
    path = folder / name
    path.write_text(body)
    return str(path)


@pytest.mark.parametrize(
    "path, name",
    [("/a/b/in_out.csv", "in_out"), ("file:///x/metavision_all_features.csv", "metavision_all_features"), ("plain", "plain")],
)
def test_table_names(path, name):
    assert tables.table_name(path) == name


def test_csv_becomes_a_named_table_of_strings(spark, tmp_path):
    path = write(tmp_path, "in_out.csv", "subject_id,x\n1,a\n2,\n")
    tables.csv_as_table(spark, path)
    got = spark.sql("select * from in_out order by subject_id")
    assert {t for _, t in got.dtypes} == {"string"} and got.count() == 2


def test_typed_readers(spark, tmp_path):
    header = ",".join(tables.WIDE_COLUMNS)
    full = "1,10,2020-01-02 03:00:00," + ",".join(str(float(i)) for i in range(9)) + ",60"
    blanks = "1,10,2020-01-02 04:00:00," + "," * 8 + ","
    no_time = "1,10,," + "," * 8 + ",60"
    path = write(tmp_path, "wide.csv", "\n".join([header, full, blanks, no_time]) + "\n")
    got = tables.read_wide(spark, path).orderBy("charttime").collect()
    assert len(got) == 2
    assert got[0]["charttime"] == T and got[0]["age"] == 60 and got[0]["motor"] == 8.0
    assert all(got[1][v] is None for v in (*VITALS, "age"))

    stays = "subject_id,icustay_id,intime,outtime\n1,10,2020-01-02 03:00:00,2020-01-03 03:00:00\n2,20,,\n"
    path = write(tmp_path, "in_out.csv", stays)
    assert tables.read_stays(spark, path).count() == 2
    assert [r["subject_id"] for r in tables.read_stays(spark, path, drop_blank_start=True).collect()] == [1]

    path = write(tmp_path, "labels.csv", "who,where,when\n1,10,2020-01-02 03:00:00\n")
    assert tables.read_labels(spark, path).first().asDict() == {"subject_id": 1, "icustay_id": 10, "charttime": T}
    path = write(tmp_path, "chart.csv", "subject_id,charttime,itemid,avg_value\n1,2020-01-02 03:00:00,211,80.5\n")
    assert tables.read_chart(spark, path).first()["avg_value"] == 80.5
    path = write(tmp_path, "gcs.csv", "subject_id,charttime,gcs\n1,2020-01-02 03:00:00,15\n")
    assert tables.read_gcs(spark, path).first()["gcs"] == 15
    path = write(tmp_path, "cohort.csv", "id,flag\n1,1\n1,0\n2,1\n")
    assert sorted(r["subject_id"] for r in tables.read_cohort(spark, path).collect()) == ["1", "2"]


def matrix(spark):
    columns = "bp_dia double, bp_sys double, heart_rate double, resp_rate double, temp_f double, spo2 double, gcs double"
    rows = [(1, 10, T, 1, 70.5, 120.0, 80.25, 18.0, 98.6, 97.0, 15.0, 60), (2, 20, T, 0, 60.0, 110.0, 70.0, 16.0, 97.6, 96.0, 14.0, 61)]
    return spark.createDataFrame(
        rows, f"subject_id long, icustay_id long, charttime timestamp_ntz, label int, {columns}, age int"
    )


def test_saved_rows_round_trip_through_part_files(spark, tmp_path):
    lines = text.labelled_lines(matrix(spark))
    assert lines.first()["line"].startswith("((1,10),(2020-01-02 03:00:00.0,1,SummedGCSPatient(1,10,2020")
    text.write_lines(lines, str(tmp_path / "set"))
    (tmp_path / "set" / "part-00000").write_text(lines.first()["line"] + "\n")
    read = text.read_lines(spark, str(tmp_path / "set"), parts_only=True)
    # Spark's own part names carry a suffix and are left out by the name filter
    assert read.count() == 1
    got = text.parse_labelled(text.read_lines(spark, str(tmp_path / "set" / "part-0*"))).where("icustay_id = 20").first()
    assert got["label"] == 0 and got["charttime"] == T and got["gcs"] == 14.0 and got["age"] == 61
    assert got["features"] == [60.0, 110.0, 70.0, 16.0, 97.6, 96.0]
    fields = text.parse_matrix(lines, start=7).orderBy(F.col("fields")[0]).collect()
    assert fields[1]["fields"] == ["70.5", "120.0", "80.25", "18.0", "98.6", "97.0", "15.0", "60"]
    assert text.parse_matrix(lines, start=5, end=6).first()["fields"] in (["10"], ["20"])


def test_buffer_lines_and_width_filter(spark):
    lines = spark.createDataFrame(
        [("(7,CompactBuffer(1 2 3 4 5 6 7 8, 1.5 2 3 4 5 6 7 8))",), ("8, CompactBuffer(1 2, 3 4)",)], "line string"
    )
    got = text.parse_sequence_lines(lines).orderBy("t").collect()
    assert [(r["seq_id"], r["t"], r["obs"][0]) for r in got] == [("7", 0, 1.0), ("7", 1, 1.5)]
    assert text.parse_sequence_lines(lines, width=None).where("seq_id = '8'").count() == 2


def test_bracketed_records_with_comments_blanks_and_continuations(spark, tmp_path):
    body = "# a comment\n\n[ 1 2 ] ; [ 3 4.5 ] ;  # tail\n[ 5 6 ] ; \\\n[ 7 8 ] ;\n[ -1 1e2 ] ;\n"
    path = write(tmp_path, "a.seq", body)
    rows = text.read_vector_sequences(spark, path).collect()
    by_record: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["record"], r["t"])):
        by_record.setdefault(r["record"], []).append(r["obs"])
    assert list(by_record.values()) == [[[1.0, 2.0], [3.0, 4.5]], [[5.0, 6.0], [7.0, 8.0]], [[-1.0, 100.0]]]
    path = write(tmp_path, "b.seq", "1; 2; 3;\n\n4;\n")
    rows = text.read_scalar_sequences(spark, path, "int").collect()
    assert sorted((r["record"], r["t"], r["obs"]) for r in rows) == [(0, 0, 1), (0, 1, 2), (0, 2, 3), (2, 0, 4)]


def test_bracketed_round_trip(spark, tmp_path):
    steps = spark.createDataFrame(
        [(1, 5, [1.0, 2.5]), (1, 2, [0.0, -1.0]), (2, 1, [3.0, 4.0])], "seq_id long, t long, obs array<double>"
    )
    lines = text.bracketed_lines(steps)
    assert {r["line"] for r in lines.collect()} == {"[ 0.0 -1.0 ]; [ 1.0 2.5 ]; ", "[ 3.0 4.0 ]; "}
    back = text.parse_bracketed(lines, "seq_id").collect()
    assert sorted((r["seq_id"], r["t"], r["obs"]) for r in back) == [(1, 0, [0.0, -1.0]), (1, 1, [1.0, 2.5]), (2, 0, [3.0, 4.0])]
    text.write_single_file(lines, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    assert sum(len(f.read_text().splitlines()) for f in (tmp_path / "one").glob("part-*")) == 2


def test_posterior_lines(spark):
    lines = spark.createDataFrame([("('(3, '42')', '[0.25, 7.5E-1]')",)], "line string")
    got = text.parse_posteriors(lines).first()
    assert (got["seq_id"], got["t"], got["p0"], got["p1"]) == (42, 3, 0.25, 0.75)
    again = text.parse_posteriors(text.posterior_lines(text.parse_posteriors(lines))).first()
    assert again == got


def test_dataset_folders(spark, tmp_path):
    path = str(tmp_path / "matrix")
    text.save_dataset(matrix(spark), path, buckets=4)
    assert text.read_dataset(spark, path).count() == 2
    one = text.read_dataset(spark, path, icustay_id=20, buckets=4)
    assert one.count() == 1 and "stay_bucket" not in one.columns
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stay_bucket" in plan


def test_rows_and_rejects_of_text_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text(
        '"SUBJECT_ID","CHARTTIME","ITEMID","AVG_VALUE"\n1,2020-01-01 00:00:00,5, 1.5 \n2,2020-01-01 01:00:00,5,\n\n3,,5,2\n'
    )
    (folder / "b.csv").write_text(
        "subject_id, charttime, itemid, avg_value\n4,2020-02-30 00:00:00,5,1\n5,2020-01-01 00:00:00,5\n6,2020-01-01 00:00:00,5,1,9\n"
        '"7","2020-01-01 00:00:00",5,"1"\nx,2020-01-01 00:00:00,5,1\n8,yesterday,5,1\n,,,\n'
    )
    got = rows.read_rows(spark, str(folder), rows.CHART_ROW, ["subject_id", "charttime"])
    assert sorted((r["subject_id"], r["itemid"], r["avg_value"]) for r in got.rows.collect()) == [(1, 5, 1.5), (2, 5, None), (7, 5, 1.0)]
    reasons = sorted((r["reason"], r["line"][:1]) for r in got.rejects.collect())
    assert reasons == [("malformed", x) for x in "4568x"] + [("missing charttime", "3"), ("missing subject_id", ",")]
    assert got.rows.select("itemid").distinct().count() == 1 and got.rejects.select("reason").count() == 7
    empty = rows.parse_rows(spark.createDataFrame([(None,), ("",)], "line string"), rows.STAY_ROW)
    assert empty.rows.count() == empty.rejects.count() == 0


def test_row_lines_round_trip(spark):
    df = matrix(spark).select("subject_id", "icustay_id", "charttime", F.lit(None).cast("int").alias("none"), "bp_sys", "age")
    schema = "subject_id long, icustay_id long, charttime timestamp_ntz, none int, bp_sys double, age int"
    back = rows.parse_rows(rows.row_lines(df), schema, ["subject_id"])
    assert sorted(back.rows.collect()) == sorted(df.collect()) and back.rejects.isEmpty()
