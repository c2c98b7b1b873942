"""Filter interactions over the document-term matrix."""

from __future__ import annotations

from collections import Counter

import numpy as np

from tests.llm import brute
from wardline.llm import filter_audit

DOCS = "doc_id long, text string, lang string"
VALUES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PLAIN = " ".join(f"word{i}" for i in range(120))


def got(spark, docs, labels, **more):
    out = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), **more).collect()
    rows = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in VALUES) for r in out}
    assert len(rows) == len(out)
    return rows


def test_counts_of_odd_rows(spark):
    docs = [
        (1, PLAIN, "en"), (2, PLAIN, "en"), (2, PLAIN, "en"), (None, PLAIN, None), (3, None, "de"), (4, "", "de"), (5, " \t\n\x0b", ""),
        (6, "A B C #", "en"), (7, PLAIN.upper(), None), (8, "é𝄞 " * 200, "fr"), (9, PLAIN + " |", "en"), (10, "x", "de"), (6, "A B C #", "fr"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, None, None), (6, 1, 1), (None, 1, 1), (99, 1, 1), (7, 0, 0)]
    assert got(spark, docs, labels) == brute.filter_audit(docs, {1, 2, 6}, {2, 6})


def test_whole_table_equals_plain_counts(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    want = brute.filter_audit(docs, {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1})
    # shards of a few rows, so that words meet over many shards
    assert got(spark, docs, labels, shard_bytes=20_000) == want


def test_matrix_and_dictionary(spark):
    long_text = " ".join(f"w{i % 700}" for i in range(60_000))  # in many pieces
    docs = [(1, long_text, "en"), (2, "b a b", "en"), (3, "", "en"), (4, "x" * 9_000 + " a", "de")]
    matrix, dictionary = filter_audit.document_term_matrix(spark.createDataFrame(docs, DOCS), shard_bytes=4_096)
    words = {r["word_id"]: r["word"].decode() for r in dictionary.collect()}
    assert len(words) == len(set(words.values())) == 703
    found = {}
    for r in matrix.collect():
        at, indices, counts = (filter_audit.unpack(r[c]) for c in ("indptr", "indices", "counts"))
        for i, doc in enumerate(r["ids"]):
            part = slice(at[i], at[i + 1])
            found[doc] = {words[k]: n for k, n in zip(indices[part].tolist(), counts[part].tolist(), strict=True)}
            assert (r["n_words"][i], r["n_distinct"][i]) == (sum(found[doc].values()), len(found[doc]))
    assert found == {doc: dict(Counter(text.split())) for doc, text, _ in docs}


def test_numbers_survive_packing():
    for values in (np.zeros(0, dtype=np.int64), np.array([0, 5, 5, 2**62, -7]), np.arange(1000)):
        assert (filter_audit.unpack(filter_audit.pack(values)) == values).all()


def test_empty_tables_and_other_columns(spark):
    assert got(spark, [], []) == {}
    docs = spark.createDataFrame([(1, "a", "en", 5, 6)], DOCS + ", part long, failed long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(docs, labels).collect()
    assert len(rows) == 600 and {r["removed"] for r in rows if r["filter_order"][r["step"] - 1] == "A"} == {1}
