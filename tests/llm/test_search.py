"""Ranked search without random access."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tests.llm import brute
from wardline.llm import ranked

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def got(spark, docs, items, **more):
    out = ranked.rank(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more)
    found = {}
    for r in sorted(out.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["rank"])):
        found.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return found


def plain(docs, items, top=10):
    want = {item: [(i, *x) for i, x in enumerate(rows, 1)] for (item, _), rows in brute.ranked(docs, items, top).items()}
    return {item: rows for item, rows in want.items() if rows}


def test_ties_repeats_and_odd_rows(spark):
    docs = [(i, "same words here", ) for i in range(30, 0, -1)]
    docs += [(31, None), (32, ""), (33, "#!"), (34, "Same WORDS"), (34, "same words"), (None, "same words"), (35, "été 𝄞 über words"), (36, "rare " * 50)]
    items = [(1, "words same"), (2, "same same rare"), (3, None), (4, "!"), (5, "nowhere"), (1, "words same"), (None, "rare"), (6, "ÉTÉ été 𝄞")]
    assert got(spark, docs, items) == plain(docs, items)


def test_blocks_of_items_and_long_texts(spark):
    rng = random.Random(3)
    words = [f"t{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 40, 400])))) for i in range(400)]
    docs.append((400, " ".join(rng.choices(words, weights, k=600_000))))  # over one slice
    items = [(i, " ".join(rng.choices(words, weights, k=12))) for i in range(12)]
    want = plain(docs, items)
    assert got(spark, docs, items) == want
    assert got(spark, docs, items, block_terms=40) == want
    assert got(spark, docs, items, top=3) == plain(docs, items, 3)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == {} and got(spark, [(1, "a")], []) == {}


def test_reads_end_early_and_stay_exact():
    """A shard's search equals full scoring for any depth, and hopeless lists aren't read to their end."""
    rng = np.random.default_rng(5)
    size = 4000
    lists = {t: np.sort(rng.choice(size, n, replace=False)) for t, n in enumerate((3000, 1500, 300, 20, 4))}
    starts = np.cumsum([0, *map(len, lists.values())])
    times = rng.integers(1, 9, starts[-1])
    row = {
        "ids": rng.permutation(size), "sizes": rng.integers(20, 400, size), "terms": np.arange(5, dtype=np.int32), "starts": starts,
        "places": np.concatenate(list(lists.values())).astype(np.int32), "times": times,
    }
    batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for v in row.values()], names=list(row))
    stats = ranked.Statistics(size, int(row["sizes"].sum()), np.array([200, 900, 2500, 5000, 7000]))
    shard = ranked._Lists(batch, stats)
    norm = 25 + 75 * row["sizes"] * size // stats.terms
    full = np.zeros(size, dtype=np.int64)
    for t in range(5):
        part = slice(starts[t], starts[t + 1])
        at = row["places"][part]
        full[at] += stats.weights[t] * (10**9 * times[part] // (1000 * times[part] + 8 * norm[at]))
    order = np.lexsort((row["ids"], -full))
    weighted = [(t, int(w)) for t, w in enumerate(stats.weights)]
    for depth in (1, 7, 256, 10_000):
        ranked.FIRST_DEPTH, kept = depth, ranked.FIRST_DEPTH
        try:
            place, score = shard.best(weighted, 10, 0)
        finally:
            ranked.FIRST_DEPTH = kept
        best = place[np.lexsort((row["ids"][place], -score))[:10]]
        assert (best == order[:10]).all() and (score == full[place]).all()
    # what earlier shards ask for rules out the rest
    assert len(shard.best(weighted, 10, int(full[order[0]]))[0]) == int((full == full[order[0]]).sum())
    assert len(shard.best(weighted, 10, int(full[order[0]]) + 1)[0]) == 0
