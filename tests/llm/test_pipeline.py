"""The pipeline's stages over small tables."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.llm import brute
from wardline.llm import align, bands

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert 0.7 * before < docs.count() <= before
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == docs.count()


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_against_plain_python_and_run(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages, written = dict(corpus_pipeline.STAGES), corpus_pipeline.written
    docs = _texts(table)
    good = written(stages["quality rules"](spark, table, FOLDER), "test")
    kept = _texts(good)
    assert kept.items() <= docs.items() and not any(brute.base_rules(t)[-1] for t in kept.values())
    verdict = {r["doc_id"]: r["kept"] for r in bands.assess(table.select("doc_id", "text")).select("doc_id", "kept").collect()}
    assert set(kept) == {d for d in docs if verdict[d]}

    lined = written(stages["line dedup"](spark, good, FOLDER), "test")
    seen = set()
    for d, t in sorted(_texts(lined).items()):
        own, rest = kept[d].split("\n"), iter(kept[d].split("\n"))
        assert all(x in rest for x in t.split("\n")) or t == ""  # some of its lines, in order
        gone = Counter(own) - Counter(t.split("\n"))
        assert all(x in seen for x in gone if len(x.encode()) >= align.MIN_LINE_BYTES)
        seen.update(own)

    single = written(stages["near duplicates"](spark, lined, FOLDER), "test")
    before = _texts(lined)
    groups = brute.jaccard_components(list(before.items()), 5, 80)
    assert _texts(single) == {d: t for d, t in before.items() if groups[d][1] == d}

    pure = written(stages["decontamination"](spark, single, FOLDER), "test")
    before, after = _texts(single), _texts(pure)
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.contamination(list(before.items()), items)
    assert set(after) == {d for d, (words, hit, *_) in found.items() if 2 * hit <= words}
    assert all(after[d] == before[d] for d in after if not found[d][-1])

    pieces = stages["packing"](spark, pure, FOLDER)
    rows = pieces.collect()
    assert {r["doc_id"] for r in rows} == set(after)
    per = Counter()
    for r in rows:
        per[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert all(total == n for (_, n), total in per.items()) and len(per) == len(after)
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect()) == sorted(rows)


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
