"""Near duplicates, repeated bytes and aligned lines."""

from __future__ import annotations

import random

import pytest

from tests.llm import brute
from wardline.llm import bottomk, bwt
from wardline.llm.components import components

FOLDER = "/root/testdata/sf0.001"
ODD = [(1001, None), (1002, ""), (1003, " \n\t"), (1004, "one"), (1005, "ONE"), (1006, "one two"), (1007, "one\ttwo"), (1008, "a b c"), (1009, "a b c a b c"), (1010, "é ü € é ü €")]


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def variants(seed: int, first: int, size: int, copies: int, edits: int) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for i in range(copies):
        own = list(words)
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append((first + i, " ".join(own)))
    return out


def _got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_near_duplicates_equal_brute_force(spark):
    rows = documents(spark) + ODD + variants(1, 2000, 150, 60, 8) + variants(2, 3000, 40, 30, 3) + variants(3, 4000, 600, 30, 25) + variants(4, 5000, 9, 20, 2)
    # one passage that many documents share, alone not enough for a link
    rng = random.Random(9)
    rows += [(6000 + i, "common passage of words that all of these hold together here " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(20))) for i in range(150)]
    rng.shuffle(rows)
    got = _got(bottomk.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85))
    want = brute.jaccard_components(rows, 3, 85)
    assert got == want
    assert sum(not k for *_, k in want.values()) > 60


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d"), (1, "e f g h"), (5, "a b c d"), (3, "e f g h"), (None, "a b c d"), (None, None), (7, "a b c d"), (7, "a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as n", "1 as id", "2 as component_id")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in bottomk.near_duplicates(df, words=3).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (5, 1, False), (3, 1, False), (None, None, True), (None, None, True), (7, 1, False), (7, 1, False)], key=str)
    kept = bottomk.keep(df, words=3)
    assert kept.columns == df.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1]
    assert bottomk.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 50)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(300)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*edges, (None, 1), (2, 2)], "a long, b long")).collect()}
    assert got == {x: find(x) for x in got} and len(got) >= 150
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _passages(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    shared = [" ".join(f"p{rng.randrange(10**5)}é" for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(40))) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            p = rng.choice(shared)
            a = rng.randrange(len(p) // 2)
            parts.insert(rng.randrange(4), p[a : a + rng.randrange(20, 160)])
        rows.append((7000 + i, "".join(parts)))
    return rows


def _cuts(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("block", [bwt.BLOCK, 16])
def test_repeated_bytes_equal_brute_force(spark, block):
    rows = documents(spark) + ODD + _passages(5) + [(8000, "ab" * 90), (8001, "ab" * 25), (8002, "x" * 49), (8003, "x" * 50), (8004, "x" * 51 + "y"), (8005, "x" * 200)]
    got = _cuts(bwt.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), block=block))
    want = brute.repeated_bytes(rows)
    assert {d: (got[d], want[d]) for d in want if got[d] != want[d]} == {}
    assert sum(n for _, n, *_ in want.values()) > 5000


def test_suffixes_of_a_block_are_sorted():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(8, 20))).encode() for _ in range(40)]
    owner, start, common = bwt.sort_contexts(texts, 6)
    got = [texts[o][s:] for o, s in zip(owner, start, strict=True)]
    assert got == sorted(got) and len(got) == sum(len(t) - 5 for t in texts)
    assert [c >= 6 for c in common[1:]] == [a[:6] == b[:6] for a, b in zip(got, got[1:], strict=False)]


def test_repeats_with_missing_and_repeated_ids(spark):
    p = "a passage that is long enough to count as a repeated one here " * 2
    rows = [(1, p), (1, "x" + p), (2, "y" + p), (None, p), (None, None), (3, None), (4, ""), (2, "y" + p)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as h", "'a' as tag")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_text"])) for r in bwt.remove_repeats(df).collect())
    n = len(p)
    assert got == sorted([("1", n, 0, 0, p.encode()), ("1", n + 1, 0, 0, b"x" + p.encode()), ("2", n + 1, n, 1, b"y"), ("2", n + 1, n, 1, b"y"), ("None", n, 0, 0, p.encode()), ("None", 0, 0, 0, b""), ("3", 0, 0, 0, b""), ("4", 0, 0, 0, b"")])
    assert bwt.remove_repeats(df.limit(0)).count() == 0


def test_contexts_of_repetitive_texts_stay_short(spark):
    rows = [(1, "reon. " * 3000), (2, "x" + "reon. " * 2000), (3, "ab" * 2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert bwt.anchor_rows(df, 50, 16).agg({"bytes": "max"}).first()[0] <= 84
    assert _cuts(bwt.remove_repeats(df, block=32)) == brute.repeated_bytes(rows)
