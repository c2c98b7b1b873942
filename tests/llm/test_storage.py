"""Archives and sharding."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import pytest

from wardline.llm import hash_tree, queries, warc
from wardline.llm.scratch import new_folder

FOLDER = "/root/testdata/sf0.001"


def _expected(rows, min_bytes=0):
    best = {}
    for page, html in rows:
        if page is not None:
            best[html or ""] = max(best.get(html or "", page), page)
    out = []
    for page, html in rows:
        b = (html or "").encode()
        top = best.get(html or "") if len(b) >= min_bytes else None
        refers = top if top is not None and page != top else None
        out.append((page, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_archive_round_trip(spark, min_bytes):
    rows = [(1, None), (2, ""), (3, "a\r\n\r\nb"), (4, "x" * 3_000_000), (9, "WARC/1.1\r\n"), (7, "é€𝄞"), (5, "é€𝄞"), (7, "é€𝄞"), (7, "other"), (None, "x"), (None, "é€𝄞"), (8, "ab"), (10, "ab")]
    pages = spark.createDataFrame([(p, h, f"http://a/{p}", "z") for p, h in rows], "page_id long, html string, url string, sha1 string")
    folder = new_folder(spark, "test-warc")
    warc.write_archive(warc.mark_revisits(pages, min_bytes=min_bytes), folder, chunk_bytes=500)
    got = warc.read_archive(spark, folder)
    assert _got(got) == _expected(rows, min_bytes)
    assert got.agg({"n_chunks": "max"}).first()[0] > 3
    assert got.where("page_id = 4").first()["url"] == "http://a/4"


def test_archive_holds_warc_records(spark):
    folder = new_folder(spark, "test-warc")
    pages = spark.createDataFrame([(1, "<p>hi", "http://a")], "page_id long, html string, url string")
    warc.write_archive(warc.mark_revisits(pages), folder, chunk_bytes=64)
    parts = spark.read.parquet(folder).orderBy("chunk_no").collect()
    record = zlib.decompress(b"".join(r["data"] for r in parts), 31)
    head, http, rest = record.split(b"\r\n\r\n", 2)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and rest == b"<p>hi\r\n\r\n"
    assert f"Content-Length: {len(http) + 4 + 5}".encode() in head
    assert parts[-1]["running_sha1"] == hashlib.sha1(b"<p>hi").hexdigest()


def test_damage_is_found(spark):
    folder, bad = new_folder(spark, "test-warc"), new_folder(spark, "test-warc")
    html = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(60))
    pages = spark.createDataFrame([(1, html, "u")], "page_id long, html string, url string")
    warc.write_archive(warc.mark_revisits(pages), folder, chunk_bytes=500)
    spark.read.parquet(folder).where("chunk_no <> 1").write.parquet(bad)
    with pytest.raises(Exception, match="is missing"):
        warc.read_archive(spark, bad).collect()


def _shuffled_bytes(df):
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if node.metrics().contains("shuffleBytesWritten"):
                total += node.metrics().apply("shuffleBytesWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def _random_pages(spark, sizes):
    rng = random.Random(5)
    rows = [(i, rng.randbytes(n // 2).hex()) for i, n in enumerate(sizes)]
    return rows, spark.createDataFrame([(p, h, f"http://a/{p}") for p, h in rows], "page_id long, html string, url string")


@pytest.mark.parametrize("chunk_bytes", [700, warc.CHUNK_BYTES])
def test_reader_does_not_shuffle_the_archive(spark, chunk_bytes):
    folder = new_folder(spark, "test-warc")
    rows, pages = _random_pages(spark, [4000] * 600)
    warc.write_archive(warc.mark_revisits(pages), folder, chunk_bytes)
    got = warc.read_archive(spark, folder)
    data = spark.read.parquet(folder).selectExpr("sum(length(data))").first()[0]
    assert data > 1_000_000
    assert 0 < _shuffled_bytes(got) < data / 10
    assert _got(got) == _expected(rows)


def test_records_cut_by_splits(spark):
    folder = new_folder(spark, "test-warc")
    rows, pages = _random_pages(spark, [*range(0, 40_000, 800), 0, 120_000])
    chunks = warc.chunk_table(warc.mark_revisits(pages).coalesce(1), 500)
    chunks.write.option("parquet.block.size", 20_000).option("compression", "none").parquet(folder)
    splits = {"spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "20k"}
    before = {k: spark.conf.get(k) for k in splits}
    try:
        for k, v in splits.items():
            spark.conf.set(k, v)
        of = spark.read.parquet(folder).selectExpr("record_no", "spark_partition_id() AS part").distinct().groupBy("record_no").count().collect()
        assert sum(r["count"] > 1 for r in of) > 3 and sum(r["count"] == 1 for r in of) > 3
        assert _got(warc.read_archive(spark, folder)) == _expected(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("held_bytes", [0, 1000, warc.HELD_BYTES])
def test_records_out_of_order_or_beyond_what_is_held(spark, held_bytes):
    folder, mixed = new_folder(spark, "test-warc"), new_folder(spark, "test-warc")
    rows, pages = _random_pages(spark, [0, 10, 900, 900, 2500, 30_000, 60_000])
    warc.write_archive(warc.mark_revisits(pages), folder, chunk_bytes=500)
    spark.read.parquet(folder).orderBy("chunk_no", "record_no").write.parquet(mixed)
    for at in (folder, mixed):
        assert _got(warc.read_archive(spark, at, held_bytes)) == _expected(rows)


@pytest.mark.parametrize("chunk_no", [0, 1])
def test_a_record_that_comes_twice_is_found(spark, chunk_no):
    folder = new_folder(spark, "test-warc")
    _, pages = _random_pages(spark, [10, 3000])
    warc.write_archive(warc.mark_revisits(pages), folder, chunk_bytes=500)
    again = spark.createDataFrame(spark.read.parquet(folder).where(f"chunk_no = {chunk_no}").collect(), warc.CHUNK_DDL)
    again.write.mode("append").parquet(folder)
    with pytest.raises(Exception, match="is there twice|is missing"):
        warc.read_archive(spark, folder).collect()


def test_empty_archive(spark):
    folder = new_folder(spark, "test-warc")
    warc.write_archive(warc.mark_revisits(spark.createDataFrame([], "page_id long, html string, url string")), folder)
    assert warc.read_archive(spark, folder).count() == 0


def test_op1_over_pages(spark):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    assert _got(queries.QUERIES["op1_warc_chunks"](spark, FOLDER)) == _expected(rows)


def test_sharding(spark):
    rows = [(r["doc_id"], r["text"], 1) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows += [(None, None, 2), (None, None, 2), (None, "x", 3), (1, "again", 4), (1, "again", 4), (2000, "", 5), *[(3000 + i, "same", 6) for i in range(500)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = hash_tree.shard(docs, 8).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    of = {}
    for r in got:
        assert of.setdefault(r["doc_id"], r["shard"]) == r["shard"]
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
    assert 0 < sum(r["grown_shard"] == 8 for r in got) < len(got) / 4
    for k in range(8):
        own = sorted(r["slot"] for r in got if r["shard"] == k)
        assert own == list(range(len(own))) and len(own) > len(got) / 16
    assert {r["doc_id"]: r["shard"] for r in hash_tree.shard(docs.repartition(7), 8).collect()} == of
    assert hash_tree.shard(docs.limit(0), 8).count() == 0


def test_weights_confine_movement(spark):
    def tree(heavy):
        return hash_tree.Node("root", tuple(
            hash_tree.Node(f"region {r}", tuple(hash_tree.Node(f"shard {r}{s}", shard=2 * r + s, own_weight=heavy if (r, s) == (1, 0) else 1.0) for s in range(2))) for r in range(3)
        ))

    from pyspark.sql import functions as F

    both = spark.range(20000).select(hash_tree.place(F.col("id"), tree(1.0)).alias("a"), hash_tree.place(F.col("id"), tree(3.0)).alias("b"))
    moved = {(r["a"], r["b"]): r["count"] for r in both.where("a <> b").groupBy("a", "b").count().collect()}
    assert moved and all(b in (2, 3) for _, b in moved)
    share = both.where("b = 2").count() / 20000
    assert abs(share - 3 / 8) < 0.02
