"""Readers and writers of the pipeline's line formats.

Every reader is a column expression over one line, so files are parsed where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.functions.clock import parse_time

# Fixed pattern: names of saved part files.
PART_FILE = r"part-\d{0,5}$"
# Fixed positions in a saved labelled row, split on commas.
LABEL_AT, STAY_AT, TIME_AT = 3, 5, 6
VITALS_FROM, VITALS_TO, GCS_AT, AGE_AT = 7, 13, 13, 14
# Fixed value: name written before the inner tuple of a saved labelled row.
ROW_NAME = "SummedGCSPatient"
DATASET_BUCKETS = 64


def read_lines(spark: SparkSession, path: str, parts_only: bool = False) -> DataFrame:
    """(line, file) of every text line; ``parts_only`` keeps saved part files."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file")
    )
    return lines.where(F.col("file").rlike("^" + PART_FILE)) if parts_only else lines


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[()]", ""))


def labelled_lines(rows: DataFrame) -> DataFrame:
    """Lines of the saved labelled matrix, nested tuples as text."""
    keys = F.concat_ws(",", "subject_id", "icustay_id")
    time = F.date_format("charttime", "yyyy-MM-dd HH:mm:ss.0")
    vitals = [F.col(c).cast("string") for c in ("bp_dia", "bp_sys", "heart_rate", "resp_rate", "temp_f", "spo2", "gcs", "age")]
    inner = F.concat_ws(",", keys, time, *vitals)
    return rows.select(
        F.concat(
            F.lit("(("), keys, F.lit("),("), time, F.lit(","), F.col("label").cast("string"),
            F.lit(f",{ROW_NAME}("), inner, F.lit(")))"),
        ).alias("line")
    )


def parse_labelled(lines: DataFrame) -> DataFrame:
    """(icustay_id, charttime, label, features, gcs, age); features are the six vitals."""
    part = F.split("line", ",")
    return lines.select(
        _plain(part[STAY_AT]).cast("long").alias("icustay_id"),
        parse_time(F.substring(_plain(part[TIME_AT]), 1, 19)).alias("charttime"),
        _plain(part[LABEL_AT]).cast("int").alias("label"),
        F.transform(
            F.slice(part, VITALS_FROM + 1, VITALS_TO - VITALS_FROM), lambda v: _plain(v).cast("double")
        ).alias("features"),
        _plain(part[GCS_AT]).cast("double").alias("gcs"),
        _plain(part[AGE_AT]).cast("int").alias("age"),
    )


def parse_matrix(lines: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """(fields): everything but digits and ``. , : -`` removed, split on commas, sliced."""
    fields = F.split(F.regexp_replace("line", r"[^0-9.,:\-]", ""), ",")
    stop = F.size(fields) if end is None else F.least(F.lit(end), F.size(fields))
    # kept as text: a field may be a time
    return lines.select(F.slice(fields, F.lit(start + 1), F.greatest(stop - start, F.lit(0))).alias("fields"))


def sequence_lines(sequences: DataFrame) -> DataFrame:
    """``id, CompactBuffer(v v ..., v v ...)`` from (seq_id, sequence array of vectors)."""
    vectors = F.transform("sequence", lambda x: F.array_join(x.cast("array<string>"), " "))
    return sequences.select(
        F.concat(
            F.col("seq_id").cast("string"), F.lit(", CompactBuffer("), F.array_join(vectors, ", "), F.lit(")")
        ).alias("line")
    )


def parse_sequence_lines(lines: DataFrame, width: int | None = 8) -> DataFrame:
    """(seq_id, t, obs) of ``id, CompactBuffer(...)`` lines; sequences of another width are dropped."""
    clean = F.regexp_replace("line", r"CompactBuffer\(|\)|\(", "")
    part = F.split(clean, ",")
    vectors = F.transform(
        F.slice(part, F.lit(2), F.size(part)),
        lambda v: F.transform(F.split(F.trim(v), r"\s+"), lambda n: n.cast("double")),
    )
    rows = lines.select(F.trim(part[0]).alias("seq_id"), vectors.alias("x"))
    if width is not None:
        rows = rows.where(F.forall("x", lambda v: F.size(v) == width))
    return rows.select("seq_id", F.posexplode("x").alias("t", "obs"))


def bracketed_lines(steps: DataFrame) -> DataFrame:
    """One ``[ v ... ]; [ v ... ];`` line per sequence, ordered by ``t``.

    The format keeps a sequence on one line, so a line is as long as its sequence.
    """
    vector = F.concat(F.lit("[ "), F.array_join(F.col("obs").cast("array<string>"), " "), F.lit(" ]; "))
    ordered = F.sort_array(F.collect_list(F.struct("t", vector.alias("v"))))
    return (
        steps.groupBy("seq_id")
        .agg(ordered.alias("s"))
        .select("seq_id", F.array_join(F.transform("s", lambda s: s["v"]), "").alias("line"))
    )


def scalar_lines(steps: DataFrame) -> DataFrame:
    """As :func:`bracketed_lines` for integers and reals, written ``v; v;``."""
    ordered = F.sort_array(F.collect_list(F.struct("t", F.concat(F.col("obs").cast("string"), F.lit("; ")).alias("v"))))
    return (
        steps.groupBy("seq_id")
        .agg(ordered.alias("s"))
        .select("seq_id", F.array_join(F.transform("s", lambda s: s["v"]), "").alias("line"))
    )


def _uncommented(lines: DataFrame) -> DataFrame:
    clean = lines.withColumn("line", F.trim(F.regexp_replace("line", "#.*$", "")))
    return clean.where(F.col("line") != "")


def parse_bracketed(lines: DataFrame, *keys: str) -> DataFrame:
    """(keys, t, obs) of bracketed vector lines; ``#`` comments and blank lines are skipped."""
    found = F.regexp_extract_all("line", F.lit(r"\[([^\]]*)\]"), F.lit(1))
    vectors = F.transform(
        found, lambda v: F.transform(F.split(F.trim(v), r"\s+"), lambda n: n.cast("double"))
    )
    return _uncommented(lines).select(*keys, F.posexplode(vectors).alias("t", "obs"))


def parse_scalars(lines: DataFrame, *keys: str, kind: str = "double") -> DataFrame:
    """(keys, t, obs) of ``v; v;`` lines of integers or reals."""
    found = F.regexp_extract_all("line", F.lit(r"([^\s;]+)\s*;"), F.lit(1))
    values = F.transform(found, lambda v: v.cast(kind))
    return _uncommented(lines).select(*keys, F.posexplode(values).alias("t", "obs"))


def sequence_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, line): one row per sequence; a trailing backslash joins the next line.

    Lines are numbered inside their file block, which a scan task reads in order, and blocks
    are shifted by the number of records that end in the blocks before them.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.rtrim("value").alias("line"),
    )
    open_end = F.col("line").endswith("\\")
    lines = raw.select(
        "file", "block", "at",
        F.when(open_end, F.expr("left(line, length(line) - 1)")).otherwise(F.col("line")).alias("line"),
        (~open_end).cast("long").alias("closes"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = lines.groupBy("file", "block").agg(F.sum("closes").alias("closes")).select(
        "file", "block", F.coalesce(F.sum("closes").over(blocks), F.lit(0)).alias("shift")
    )
    numbered = lines.withColumn("inside", F.coalesce(F.sum("closes").over(in_block), F.lit(0))).join(
        shifts, ["file", "block"]
    )
    pieces = F.sort_array(F.collect_list(F.struct("block", "at", "line")))
    return (
        numbered.groupBy("file", (F.col("inside") + F.col("shift")).alias("record"))
        .agg(pieces.alias("p"))
        .select("file", "record", F.array_join(F.transform("p", lambda p: p["line"]), " ").alias("line"))
    )


def read_vector_sequences(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, t, obs) of bracketed vector sequences."""
    return parse_bracketed(sequence_records(spark, path), "file", "record")


def read_scalar_sequences(spark: SparkSession, path: str, kind: str = "double") -> DataFrame:
    """(file, record, t, obs) of integer or real sequences."""
    return parse_scalars(sequence_records(spark, path), "file", "record", kind=kind)


def posterior_lines(rows: DataFrame) -> DataFrame:
    """``('(idx, 'id')', '[p0, p1]')`` lines from (seq_id, t, p0, p1)."""
    return rows.select(
        F.concat(
            F.lit("('("), F.col("t").cast("string"), F.lit(", '"), F.col("seq_id").cast("string"),
            F.lit("')', '["), F.col("p0").cast("string"), F.lit(", "), F.col("p1").cast("string"), F.lit("]')"),
        ).alias("line")
    )


def parse_posteriors(lines: DataFrame) -> DataFrame:
    """(seq_id, t, p0, p1) of posterior lines."""
    part = F.split(F.regexp_replace("line", r"[()'\[\]]", ""), ",")
    return lines.select(
        F.trim(part[1]).cast("long").alias("seq_id"),
        F.trim(part[0]).cast("int").alias("t"),
        F.trim(part[2]).cast("double").alias("p0"),
        F.trim(part[3]).cast("double").alias("p1"),
    )


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("overwrite").text(path)


def write_single_file(lines: DataFrame, path: str) -> None:
    """All lines in one output file, in no set order: the last step alone runs as one task.

    The file is written at one task's speed, whatever its size; :func:`write_lines` has no such step.
    """
    lines.select("line").repartition(1).write.mode("overwrite").text(path)


def save_dataset(matrix: DataFrame, path: str, buckets: int = DATASET_BUCKETS) -> None:
    """Parquet in folders of stays, so that a stay can be read back without a full scan."""
    bucketed = matrix.withColumn("stay_bucket", F.pmod("icustay_id", F.lit(buckets)))
    bucketed.write.mode("overwrite").partitionBy("stay_bucket").parquet(path)


def read_dataset(spark: SparkSession, path: str, icustay_id: int | None = None, buckets: int = DATASET_BUCKETS) -> DataFrame:
    df = spark.read.parquet(path)
    if icustay_id is not None:
        df = df.where((F.col("stay_bucket") == icustay_id % buckets) & (F.col("icustay_id") == icustay_id))
    return df.drop("stay_bucket")
