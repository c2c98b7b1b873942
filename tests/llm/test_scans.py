"""Row-by-row scans: compression bands and decontamination."""

from __future__ import annotations

import pytest

from tests.llm import brute
from wardline.llm import bands, decontaminate, queries

FOLDER = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (3, " \n\t"), (4, "a b c " * 40), (5, "Ünï çöd € 𝄞 " * 30 + "\n\nx\nx\nx "), (6, "one"), (None, "x\ny\nx\n"), (7, "\n")]


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_base_rules(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()] + ODD
    got = bands.assess(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute.base_rules(r["text"]), r["text"][:80]
        assert not (r["base_failed"] and r["kept"])


def test_bands_reject_repetition_and_noise(spark):
    import base64
    import random

    rng = random.Random(1)
    prose = documents(spark).where("n_chars > 3000").first()["text"]
    noise = " ".join(base64.b85encode(rng.randbytes(9)).decode() for _ in range(400))
    half = prose + " ".join(f"buy now cheap {i % 7}" for i in range(4000))
    rows = [(1, prose), (2, noise), (3, half), (4, "same words here again " * 200)]
    got = {r["doc_id"]: r for r in bands.assess(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["kept"] and not got[2]["kept"] and not got[3]["kept"] and not got[4]["kept"]
    assert not got[2]["base_failed"] and got[3]["n_bad_chunks"] > 0


def test_noise_of_several_alphabets_fails_at_each_length(spark):
    import random
    import string

    rng = random.Random(5)

    def noise(alphabet, n):
        return " ".join("".join(rng.choices(alphabet, k=rng.randint(3, 10))) for _ in range(n // 6))[:n]

    letters_digits = string.ascii_letters + string.digits
    # from 4 KB random lower-case letters, from 32 KB hex digits too
    cases = [(a, n) for a in (letters_digits, string.printable[:94]) for n in (450, 700, 1000, 1500, 3000, 6000, 20000, 40000)]
    cases += [(string.ascii_lowercase, n) for n in (6000, 20000, 40000)] + [("0123456789abcdef", 40000)]
    rows = [(i, noise(a, n)) for i, (a, n) in enumerate(cases)]
    prose = [r["text"] for r in documents(spark).where("n_chars > 3500").collect()]
    part = " ".join(prose)[:20000]
    rows += [(100, part + noise(letters_digits, 9000))]  # a third of it
    rows += [(200, part), (201, part[:4097])]  # a last chunk of one byte says nothing
    got = {r["doc_id"]: r for r in bands.assess(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [c for i, c in enumerate(cases) if got[i]["kept"]] == [] and not got[100]["kept"]
    assert not any(got[i]["base_failed"] for i in range(len(cases))) and got[200]["kept"] and got[201]["kept"]


def test_bands_keep_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "w " * 60 + "some more", 7, True)], "doc_id long, text string, n_words int, kept boolean")
    assert bands.keep(df).columns == df.columns
    assert bands.assess(df).select("n_words").first()[0] == 62
    assert bands.assess(df.limit(0)).count() == 0 and bands.keep(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WINDOWS, 150])
def test_contamination(spark, block):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    items += [(900, "one two"), (901, None), (902, "!!"), (902, "one two"), (None, "x")]
    extra = [(901, "One, TWO three one two"), *[(i, t) for i, (_, t) in enumerate(ODD, 902)], (950, items[0][1]), (951, "z " + items[1][1] + " é")]
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()] + extra
    want = brute.contamination(rows, [("null" if i is None else i, t) for i, t in items])
    found = decontaminate.find(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_windows=block)
    got = {r[0]: tuple(r)[1:] for r in decontaminate.digest(found).collect()}
    assert got == want and sum(x[-1] for x in want.values()) > 5


def test_clean_removes_spans_and_documents(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = spark.createDataFrame(
        [(1, "before " * 30 + item.upper() + " after" * 3, "a"), (2, item, "b"), (3, "plain é", "c"), (4, None, "d")], "doc_id long, text string, items string"
    )
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontaminate.clean(docs, bench).collect()}
    assert got == {1: "before " * 30 + " after" * 3, 3: "plain é", 4: None}
    assert decontaminate.clean(docs, bench.limit(0)).columns == docs.columns
    assert decontaminate.clean(docs.limit(0), bench).count() == 0


def test_queries_run(spark):
    n = documents(spark).count()
    for name in ("op2_compression_bands", "op3_decontamination"):
        assert queries.QUERIES[name](spark, FOLDER).count() == n


def test_blocks_with_clashing_columns(spark):
    item = " ".join(f"w{i}" for i in range(14))
    rows = [(1, f"a {item} b", 5, "x", 7), (2, "none of it", 6, None, 8), (3, None, 1, "y", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, was_items int, was_hit_spans string, items int")
    items = spark.createDataFrame([(1, item), (2, "none of")], "item_id long, text string")
    found = decontaminate.find(docs, items, block_windows=2)
    got = {r["doc_id"]: (r["was_items"], r["was_hit_spans"], r["hit_spans"], r["items"]) for r in found.collect()}
    assert got == {1: (5, "x", [[1, 15]], ["1"]), 2: (6, None, [[0, 2]], ["2"]), 3: (1, "y", [], [])}
    assert decontaminate.clean(docs, items).columns == docs.columns
