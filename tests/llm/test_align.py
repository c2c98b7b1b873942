"""Line dedup by alignment."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from wardline.llm import align

LINES = [f"line number {i} with words enough to tell {i * 7919}" for i in range(60)]


def _dedup(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed", F.lit("x")).withColumn("row", F.lit(1)).withColumn("version", F.lit(2))
    return sorted(((r["row"]["doc_id"], r["kept_text"]) for r in align.dedup(df).collect()), key=str)


def test_patience_is_a_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randrange(25))]
        b = [rng.randrange(12) for _ in range(rng.randrange(25))]
        got = align.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    assert align.patience([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]
    assert align.patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)] and align.patience([], [1]) == []


def test_common_blocks_go_from_the_later_document(spark):
    own = [[f"own line of document {d} and no other, number {i}" for i in range(4)] for d in range(9)]
    rows = [
        (1, "\n".join(own[1] + LINES[:5])),
        (2, "\n".join([*own[2][:2], *LINES[1:4], *own[2][2:]])),  # three of them in the middle
        (3, "\n".join(own[1] + LINES[:5])),  # an exact copy
        (4, "\n".join([*own[4], "short", ""])),
        (5, "short\n\n" + "\n".join(own[5])),  # short lines alone make no pair
        (6, None), (7, ""), (None, "\n".join(LINES[:5])), (None, "\n".join(LINES[:5])),
        (8, "\n".join(LINES[20:25])), (8, "\n".join(LINES[20:25] + own[8])),  # one id
    ]
    want = [(1, rows[0][1]), (2, "\n".join(own[2])), (3, ""), *rows[3:]]
    assert _dedup(spark, rows) == sorted(want, key=str)


def test_lines_of_all_documents_go_by_their_words_alone(spark):
    long, short = "a line that stands in every one of the documents here", "fewer words: incomprehensibilities, notwithstanding"
    own = "words of document {} alone\nthat no other document has, {}"
    for n in (6, 200):
        rows = [(i, f"{short if i % 2 else long}\n{own.format(i, i)}") for i in range(2 * n)]
        got = dict(_dedup(spark, rows))
        assert got[0] == rows[0][1]
        assert all(got[i] == (rows[i][1] if i % 2 else own.format(i, i)) for i in range(1, 2 * n))


def test_passages_in_any_order_all_go(spark):
    rng = random.Random(2)
    passages = [[f"passage {p} line {i} with a number of words in it" for i in range(3)] for p in range(7)]
    rows = []
    for d in range(60):
        rng.shuffle(passages)
        rows.append((d, f"own {d}\n" + f"\nthen {d}\n".join("\n".join(x) for x in passages)))
    got = dict(_dedup(spark, rows))
    assert got[0] == rows[0][1] and not any("passage" in got[d] for d in range(1, 60))


def _bounds(rows):
    """Lines that must go and lines that may go, of each text, from all pairs and all their common blocks."""
    first = {}
    for d, t in rows:
        first.setdefault(t, d)
    texts = {d: t.split("\n") for d, t in rows}
    must, may = {d: set() for d in texts}, {d: set() for d in texts}
    for d, own in texts.items():
        for e, earlier in texts.items():
            if e >= d:
                continue
            where = {}
            for i, x in enumerate(earlier):
                where.setdefault(x, []).append(i)
            for j, x in enumerate(own):
                for i in where.get(x, ()):
                    if i and j and earlier[i - 1] == own[j - 1]:
                        continue
                    n = 0
                    while i + n < len(earlier) and j + n < len(own) and earlier[i + n] == own[j + n]:
                        n += 1
                    block = own[j : j + n]
                    if sum(len(y.encode()) for y in block) >= align.MIN_BLOCK_BYTES:
                        may[d] |= set(range(j, j + n))
                        if sum(len(y.split()) for y in block) >= align.MIN_WORDS and first[rows_text(own)] == d:
                            must[d] |= set(range(j, j + n))
    return must, may


def rows_text(lines):
    return "\n".join(lines)


def test_removed_lines_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.where("text is not null").collect()]
    rng = random.Random(9)
    some = [t.split("\n") for _, t in rows if 3 < t.count("\n") < 30]
    top = max(d for d, _ in rows) + 1
    for d in range(top, top + 80):  # blocks of three texts each, with lines between them
        made = []
        for _ in range(3):
            x = rng.choice(some)
            a = rng.randrange(len(x) - 1)
            made += [f"between {d}", *x[a : a + rng.randrange(1, 5)]]
        rows.append((d, "\n".join(made)))
    must, may = _bounds(rows)
    got = {r["row"]["doc_id"]: set(r["removed"]) for r in align.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(map(len, must.values())) > 100
    for d in got:
        assert must[d] <= got[d] <= may[d], d


def test_many_near_copies(spark):
    rng = random.Random(8)
    rows = []
    for d in range(120):
        lines = list(LINES[:20])
        lines[rng.randrange(20)] = f"changed in document {d} alone, and nowhere else"
        rows.append((d, "\n".join(lines)))
    got = dict(_dedup(spark, rows))
    assert got[0] == rows[0][1]
    left = [set(t.split("\n")) for d, t in got.items() if d]
    assert all(any(x.startswith("changed") for x in s) for s in left) and max(map(len, left)) <= 3


def test_clean_keeps_columns(spark):
    df = spark.createDataFrame([(1, "\n".join(LINES), "a"), (2, "\n".join(LINES), "b"), (3, " ", "c"), (4, None, "d")], "doc_id long, text string, n_lines string")
    got = align.clean(df)
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3, 4]
    assert align.clean(df.limit(0)).count() == 0


def test_a_block_whose_lines_first_occur_elsewhere(spark):
    own = [[f"own line of document {d} and no other, number {i}" for i in range(3)] for d in range(40)]
    short = [f"block of the two, {i}" for i in range(4)]  # 18 bytes each, so three make a block
    block = [*short, *LINES[:2]]
    rows = [(d, "\n".join([own[d][0], block[d], *own[d][1:]])) for d in range(6)]  # each line alone first
    rows += [(6, "\n".join([*own[6], *block])), (7, "\n".join([*block, *own[7]]))]
    # the first holder has the runs in another order, the second one in the same
    p, q = LINES[10:14], LINES[20:22]
    rows += [(8, "\n".join([*q, own[8][0], *p])), (9, "\n".join([*p, own[9][0], *q])), (10, "\n".join([*p, own[10][0], *q]))]
    rows += [(d, "\n".join(own[d])) for d in range(11, 40)]
    got = dict(_dedup(spark, rows))
    assert got[7] == "\n".join(own[7])
    assert got[10] == own[10][0]


def test_long_runs_and_copies_go_however_common(spark):
    line = " ".join(f"word{i}" for i in range(51))
    run = [" ".join(f"part{j} {i}" for i in range(6)) for j in range(5)]
    own = [f"a line of document {d} and of no other document" for d in range(200)]
    alone = "the only line of these documents"  # under the least block
    copy = "the only line of these other documents, which are copies"
    rows = [(d, f"{own[d]}\n{line}\nthen\n" + "\n".join(run) + f"\nand last {d}") for d in range(100)]
    rows += [(d, f"{run[0]}\n{own[d]}") for d in range(100, 150)]
    rows += [(d, copy) for d in range(150, 200)] + [(d, alone) for d in range(200, 202)]
    rows += [(202, f"{copy}\n{own[1]} or nearly so"), (203, f"{own[2]} again\n{line}")]
    got = dict(_dedup(spark, rows))
    assert got[0] == rows[0][1] and all(got[d] == f"{own[d]}\nand last {d}" for d in range(1, 100))
    assert got[150] == copy and all(got[d] == "" for d in range(151, 200)) and got[201] == alone
    assert got[203] == f"{own[2]} again"


def test_windows_cover_blocks():
    rng = random.Random(3)
    for _ in range(200):
        lines = [rng.randrange(30) for _ in range(40)]
        sizes, words = [10 + x % 25 for x in lines], [x % 7 for x in lines]
        weights = {x: (x % 5) / 8 for x in range(28)}
        found = align.windows(lines, sizes, words, weights)
        for a in range(40):
            for b in range(a, 40):
                part = lines[a : b + 1]
                if any(sizes[i] >= 16 and lines[i] not in weights for i in range(a, b + 1)) or sum(sizes[a : b + 1]) < 40:
                    continue
                if sum(weights.get(x, 0) for x in set(part)) >= 0.5 + 1e-9:
                    inside = [w for w in found if a <= w[0] and w[1] <= b]
                    assert {i for x, y in inside for i in range(x, y + 1)} == set(range(a, b + 1))


def test_all_earlier_holders_of_a_rare_line_are_met(spark):
    own = [f"a line of document {d} and of no other document" for d in range(120)]
    common = "standing nearly everywhere: incomprehensibly makes no pair"  # below the words of a block
    rows = [(d, f"{own[d]}\n{common}\n{own[d]} end") for d in range(60)] + [(d, own[d]) for d in range(60, 100)]
    rows += [(100, f"{LINES[0]}\n{own[100]}"), (101, f"{own[101]}\n{LINES[0]}\nnext\n{common}"), (102, f"{LINES[0]}\n{own[102]}\n{common}")]
    got = dict(_dedup(spark, rows))
    assert got[102] == own[102] and got[59] == rows[59][1]
