"""The corpus pipeline: documents to packed sequences, in stages that are written and read again.

All stages but the last return the columns of ``docs``, whatever their names. An empty table stays
empty, and packs into no pieces. Rows without an id take part as their stage's operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import align, bands, bottomk, decontaminate, packing
from wardline.llm.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words and compression pass; the others go, null and empty texts with them.

    A text is judged alone and whole, so repeated rows all stay or all go.
    """
    return bands.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go; so do documents that are left without a word.

    Null texts and texts without words stay as they are. Rows of one id take nothing from each other.
    """
    return align.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on shingles of five words, the least id.

    Texts without words link with nothing and stay. Of rows that repeat an id one stays, the same
    in each run; rows without an id all stay.
    """
    return bottomk.keep(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go; so do documents that are mostly such passages.

    Null texts, and all texts if the benchmark is empty, stay as they are; repeated rows are cut alike.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places; a null or empty text is one id.

    Repeated rows are packed each.
    """
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Compression and tokens have no SQL; the tests hold stages and run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
