"""Toxicity, secrets and packing."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import packing, queries, secrets, toxicity

FOLDER = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "\n"), (3, "\n"), (None, "a b"), (4, "word " * 3000), (5, "é€𝄞 <|endoftext|> x"), (6, "   \t  many   blanks  ")]


def test_held_out_toxicity(spark):
    got = queries.QUERIES["op6_counterfactual_toxicity"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").toPandas()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all() and got.score.between(0, 1).all()
    test = got[got.held_out]
    rank, toxic = test.score.rank(), test.toxic == 1
    assert (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum()) > 0.85


def _identity_rows(n: int) -> list[tuple]:
    rng = random.Random(1)
    filler = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = rng.choices(filler, k=12)
        toxic = i % 2
        if toxic and rng.random() < 0.7:
            words.append("idiot")
        if rng.random() < (0.8 if toxic else 0.1):
            words.append("muslims")  # named more often in toxic texts
        rows.append((i, " ".join(words), toxic))
    return rows


def test_swaps_make_naming_a_group_neutral(spark):
    df = spark.createDataFrame(_identity_rows(1200), "doc_id long, text string, toxic int")
    rows = toxicity.training_rows(df.select("text", F.col("toxic").alias("label")))
    neutral = spark.createDataFrame([(1, "word1 word2 word3"), (2, "word1 word2 word3 muslims"), (3, "word1 word2 word3 idiot")], "doc_id long, text string")

    def scores(penalty):
        return {r["doc_id"]: r["score"] for r in toxicity.score(neutral, toxicity.fit(rows, penalty=penalty)).collect()}

    plain, fair = scores(0.0), scores(10.0)
    assert plain[2] - plain[1] > 0.3 and abs(fair[2] - fair[1]) < 0.1
    assert fair[3] > 0.8


def test_scores_of_odd_texts_and_labels(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("score", F.lit("x"))
    none = spark.createDataFrame([(None, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(ODD) and {r["score"] for r in got} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_secret_forest(spark):
    rng = random.Random(2)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f'some prose here token = "{key(40)}" and more', "a/config/x.py") for i in range(150)]
    rows += [(200 + i, f"write to user{i}@mail{i}.example{i}.com or see commit {key(40)} now", "b.txt") for i in range(150)]
    rows += [(400, f'password: "{key(32)}"', None), (401, f"the sha256 is {key(64)}", None), (402, None, "x"), (403, "", ""), (404, "short ab12", "x"), (None, f'secret="{key(40)}"', "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("value", F.lit(1))
    got = secrets.scan(docs).collect()
    by = {(r["id"], r["nth"]): r["is_secret"] for r in got}
    assert all(by[i, 0] for i in range(150)) and by[400, 0] and by[None, 0]
    assert not any(v for (i, _), v in by.items() if i is not None and 200 <= i < 400) and not by[401, 0]
    assert not {402, 403, 404} & {r["id"] for r in got}
    assert secrets.scan(docs.limit(0)).count() == 0


def test_findings_stay_where_nothing_is_labelled(spark):
    docs = spark.createDataFrame([(1, "an unknown 0123456789abcdef01 thing", None)], "doc_id long, text string, source string")
    got = secrets.scan(docs).collect()
    assert [(r["value"], r["left"], r["right"], r["probability"], r["is_secret"]) for r in got] == [("0123456789abcdef01", "an unknown ", " thing", 0.5, True)]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_packing_is_whole(spark, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300).collect()] + [(d and 10_000 + d, t) for d, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("x"))
    got = packing.pack(docs, with_ids=True).toPandas()
    want = sorted(str([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for _, t in rows)
    texts = []
    for _, own in got.groupby(["doc_id", "doc_tokens"], dropna=False):
        starts = own.sort_values("start", kind="stable")
        copies = (starts.start == 0).sum()
        for c in range(copies):
            part = starts.groupby("start").nth(c).sort_values("start")
            texts.append(str([int(x) for ids in part.ids for x in ids]))
    assert sorted(texts) == want
    assert all(zlib.crc32(np.array(i, dtype="<u4").tobytes()) == c for i, c in zip(got.ids, got.ids_crc32, strict=True))
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 1024
    used = got.sequence_id.nunique()
    assert used == got.sequence_id.max() + 1 and got.length.sum() > 0.96 * 1024 * used
    assert packing.pack(docs.limit(0)).count() == 0


def test_parts_of_long_texts_give_the_same_ids(tokenizer):
    text = " ".join(f"Wörter {i}'s  und\n mehr" for i in range(400))
    parts = list(packing._parts(text, 100))
    assert "".join(parts) == text and len(parts) > 20
    assert [x for p in parts for x in tokenizer.encode(p, add_special_tokens=False).ids] == tokenizer.encode(text, add_special_tokens=False).ids


def test_column_generation_meets_demand_near_its_bound():
    rng = random.Random(5)
    demand = {rng.randrange(20, 500): rng.randrange(1, 400) for _ in range(60)}
    patterns, bound = packing.column_generation(demand, 512)
    for size, n in demand.items():
        assert sum(p.get(size, 0) * use for p, use in patterns) == pytest.approx(n, abs=1e-6)
    assert bound <= sum(use for _, use in patterns) + 1e-6 <= 1.05 * bound + 1
    whole = packing.plan(demand, 512)
    assert {s: sum(p.get(s, 0) * t for p, t in whole) for s in demand} == demand and packing.plan({}) == []


def test_values_in_a_secrets_place_are_candidates(spark):
    from wardline.llm import secrets

    text = "password = \"hunter2!\"\napi_key: abcdefghijk\npwd='sh!rt'\nurl http://bob:p@ss:w$rd@host/x and token => a&b$c\nplain: none"
    found = secrets.candidates(spark.createDataFrame([(1, text, "a.py")], "doc_id long, text string, source string"))
    rows = secrets.features(found, []).orderBy("nth").collect()
    assert [r["value"] for r in rows] == ["hunter2!", "abcdefghijk", "sh!rt", "p@ss:w$rd", "a&b$c"]
    assert all(r["secret_word"] == 1 and r["assigned"] == 1 for r in rows) and rows[3]["plain_word"] == 0
