"""Ranked lexical search without random access (NRA) over document shards.

Documents are indexed in shards of bounded size: a shard has the lists of its documents for each
query term, sorted by impact. A search reads the lists of its terms in step, from the highest
impact down. What has been read of a document is the lower end of its score; its unread terms can
add no more than the impact last read from their lists, which gives the upper end. Documents whose
upper end falls below the tenth best lower end drop out. Reading goes on until both ends of all
others meet, so membership, order, ties and scores are exact. The best of the shards are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm import text
from wardline.llm.decontaminate import normalised
from wardline.llm.scratch import written

TOP = 10
#: Length share of the score's document norm, in percent.
NORM_PERCENT = 75
#: A shard is closed at this many documents or this many entries of its lists.
SHARD_DOCUMENTS, SHARD_ENTRIES = 16_384, 2_000_000
#: Distinct (item, term) rows whose items are searched in one pass over the documents.
BLOCK_TERMS = 200_000
#: Entries that are read of each list at first; each further step reads so many times more.
FIRST_DEPTH, DEEPER = 256, 4
#: An item's best rows of all tasks are merged in so many groups first.
MERGE_GROUPS = 64

_INDEX = pa.schema(
    [
        ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())),
        ("starts", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())),
    ]
)
_INDEX_DDL = "ids array<long>, sizes array<long>, terms array<int>, starts array<long>, places array<int>, times array<long>"


class Query(NamedTuple):
    item_id: object
    terms: list[tuple[int, int]]  # number of the term in the block, and how often the item has it


def item_terms(items: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, body, terms): one row per distinct item, with its terms as they follow one another.

    Items are told apart by id and text; repeated rows are one item.
    """
    named = items.select(items[f"`{item_id}`"].alias("item"), F.coalesce(items[f"`{item_text}`"], F.lit("")).alias("body")).distinct()
    return normalised(named, "body").withColumnRenamed("_words", "terms")


def _blocks(items: DataFrame, item_id: str, item_text: str, block_terms: int) -> Iterator[list]:
    """Items in groups of about ``block_terms`` terms, one group on the driver at a time."""
    # read once per block
    found = written(item_terms(items, item_id, item_text).where(F.size("terms") > 0), "items")
    total = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // block_terms))
    place = F.pmod(F.xxhash64("item", "body"), F.lit(blocks))
    for b in range(blocks):
        if rows := found.where(place == b).select("item", "terms").orderBy("item", "body").collect():
            yield rows


class _Shard:
    """Postings of documents, gathered until the shard is closed."""

    def __init__(self):
        self.ids: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.entries: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.documents = self.n_entries = 0

    def add(self, s: text.Slice, ids: pa.Array, vocabulary: pa.Array) -> None:
        sizes = np.zeros(s.rows, dtype=np.int64)
        for piece in text.pieces(text.Slice(s.first, text.LOWER[s.data], s.offsets), text.ALNUM):
            row, words = text.word_array(piece, text.ALNUM)
            sizes += text.per_row(s.rows, row)
            found = pc.index_in(words, value_set=vocabulary)
            known = found.is_valid().to_numpy(zero_copy_only=False)
            key, times = np.unique(row[known] * len(vocabulary) + found.drop_null().to_numpy(), return_counts=True)
            self.entries.append((key % len(vocabulary), key // len(vocabulary) + self.documents, times))
            self.n_entries += len(key)
        self.ids.append(ids)
        self.sizes.append(sizes)
        self.documents += s.rows

    def batch(self) -> pa.RecordBatch:
        term, place, times = (np.concatenate(c) for c in zip(*self.entries, strict=True))
        # a long text's pieces may each have a term
        key, back = np.unique(term * self.documents + place, return_inverse=True)
        term, place = key // self.documents, key % self.documents
        terms, starts = np.unique(term, return_index=True)
        values = [pa.concat_arrays(self.ids), np.concatenate(self.sizes), terms, np.append(starts, len(key)), place, np.bincount(back, times, len(key))]
        columns = []
        for value, field in zip(values, _INDEX, strict=True):
            made = value if isinstance(value, pa.Array) else pa.array(value.astype(field.type.value_type.to_pandas_dtype()))
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(made)], pa.int32()), made))
        return pa.RecordBatch.from_arrays(columns, schema=_INDEX)


def index(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards of documents: ids and numbers of terms, and for each query term the places and times.

    ``terms`` are numbers in ``vocabulary``; the entries starts[i] to starts[i + 1] belong to
    terms[i], ``places`` number the shard's documents.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array([t.encode() for t in shared.value], pa.large_binary())
        shard = _Shard()
        for batch in batches:
            for s in text.slices(batch.column(1)):
                shard.add(s, batch.column(0).slice(s.first, s.rows), terms)
                if shard.documents >= SHARD_DOCUMENTS or shard.n_entries >= SHARD_ENTRIES:
                    yield shard.batch()
                    shard = _Shard()
        if shard.documents:
            yield shard.batch()

    return text.map_batches(source, run, _INDEX_DDL)


class Statistics(NamedTuple):
    documents: int  # with at least one term
    terms: int  # of all documents, with repeats
    weights: np.ndarray  # of each term of the block


def statistics(shards: DataFrame, n_terms: int) -> Statistics:
    """Counts over all shards; what comes to the driver is one number per term of the block."""
    n, total = shards.select(F.explode("sizes").alias("n")).agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    sizes = F.transform("terms", lambda t, i: F.struct(t.alias("term"), (F.get("starts", i + 1) - F.get("starts", i)).alias("df")))
    df = shards.select(F.inline(sizes)).groupBy("term").agg(F.sum("df").alias("df"))
    weights = np.zeros(n_terms, dtype=np.int64)
    for r in df.collect():
        weights[r["term"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1)))
    return Statistics(n, total, weights)


class _Lists:
    """A shard's lists, sorted by impact, and the search over them."""

    def __init__(self, row: pa.RecordBatch, stats: Statistics):
        def values(name: str) -> pa.Array:
            return row.column(name).flatten()

        ids = values("ids")
        self.unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        starts, place, times = (values(c).to_numpy() for c in ("starts", "places", "times"))
        terms = values("terms").to_numpy()
        norm = 100 - NORM_PERCENT + (NORM_PERCENT * values("sizes").to_numpy() * stats.documents) // max(stats.terms, 1)
        impact = (1_000_000_000 * times) // (1000 * times + 8 * norm[place])
        order = np.lexsort((-impact, np.repeat(np.arange(len(terms)), np.diff(starts))))
        self.place, self.impact = place[order], impact[order]
        self.of = {t: (a, b) for t, a, b in zip(terms.tolist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True)}

    def best(self, weighted: list[tuple[int, int]], top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents that may be among the ``top`` best and reach ``floor``."""
        lists = [(a, *self.of[t]) for t, a in weighted if a > 0 and t in self.of]
        lower = np.zeros(len(self.ids), dtype=np.int64)
        depth, read = FIRST_DEPTH, 0
        while True:
            open_total, settled = 0, np.zeros(len(lower), dtype=np.int64)
            for a, start, end in lists:
                now, before = min(start + depth, end), min(start + read, end)
                lower[self.place[before:now]] += a * self.impact[before:now]
                if now < end:  # its unread documents may have as much as the last one read
                    most = a * int(self.impact[now - 1])
                    open_total += most
                    settled[self.place[start:now]] += most
            upper = lower + open_total - settled
            reach = max(floor, 1)
            if len(lower) >= top:
                reach = max(reach, int(np.partition(lower, len(lower) - top)[len(lower) - top]))
            alive = np.flatnonzero(upper >= reach)
            if (upper[alive] == lower[alive]).all():
                return alive, lower[alive]
            depth, read = depth * DEEPER, depth


def _leaders(scores: np.ndarray, unnamed: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    return np.lexsort((ids, unnamed, -scores))[:top]


def search(shards: DataFrame, queries: list[Query], stats: Statistics, top: int = TOP) -> DataFrame:
    """(query, doc_id, score): each task's best documents of each query, by its place in ``queries``.

    A task passes on the score that its best rows so far ask for, so later shards are read less deep.
    """
    weighted = [[(t, int(stats.weights[t]) * n) for t, n in q.terms] for q in queries]
    shared = shards.sparkSession.sparkContext.broadcast((weighted, stats))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts = shared.value
        empty = np.zeros(0, dtype=np.int64)
        held = [(empty, empty.astype(bool), empty)] * len(wanted)  # scores, ids missing, ids
        for batch in batches:
            for i in range(batch.num_rows):
                lists = _Lists(batch.slice(i, 1), counts)
                for q, terms in enumerate(wanted):
                    scores, unnamed, ids = held[q]
                    place, found = lists.best(terms, top, int(scores[-1]) if len(scores) == top else 0)
                    scores, unnamed, ids = np.append(scores, found), np.append(unnamed, lists.unnamed[place]), np.append(ids, lists.ids[place])
                    first = _leaders(scores, unnamed, ids, top)
                    held[q] = scores[first], unnamed[first], ids[first]
        query = np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
        if len(query):
            scores, unnamed, ids = (np.concatenate(c) for c in zip(*held, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids, mask=unnamed), pa.array(scores)], names=["query", "doc_id", "score"])

    return text.map_batches(shards, run, "query long, doc_id long, score long")


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The best rows of each query with their rank; first in groups, so no task has all of a query's."""
    best_first = [F.desc("score"), F.asc_nulls_last("doc_id")]
    grouped = found.withColumn("_group", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_GROUPS)))
    in_group = Window.partitionBy("query", "_group").orderBy(*best_first)
    of_query = Window.partitionBy("query").orderBy(*best_first)
    few = grouped.withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= top).select("query", "rank", "doc_id", "score")


def rank(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item with a score above 0.

    Equal scores go by rising id, a null id last. Every row of ``docs`` is a document, also where
    rows repeat; repeated rows of ``items`` are one item. Null, empty and wordless texts have no
    terms: such documents and items have no rows, nor has a term that no document holds any weight
    to give. Other columns are not read. Items are searched in blocks of about ``block_terms`` terms,
    one pass over the documents each, so what is broadcast stays bounded.
    """
    spark = docs.sparkSession
    results = []
    id_type = items.schema[item_id].dataType
    for rows in _blocks(items, item_id, item_text, block_terms):
        vocabulary = sorted({t for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        queries = []
        for r in rows:
            times: dict[int, int] = {}
            for t in r["terms"]:
                times[number[t]] = times.get(number[t], 0) + 1
            queries.append(Query(r["item"], sorted(times.items())))
        shards = written(index(docs, vocabulary, id_col, text_col), "shards")
        found = _merged(search(shards, queries, statistics(shards, len(vocabulary)), top), top)
        names = spark.createDataFrame([(i, q.item_id) for i, q in enumerate(queries)], _named(id_type))
        # a block's items are bounded
        results.append(found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return _nothing(spark, id_type)
    if len(results) == 1:
        return results[0]
    out = written(results[0], "ranked")
    for more in results[1:]:
        out = out.unionByName(written(more, "ranked"))
    return out


def _named(id_type):
    from pyspark.sql.types import LongType, StructField, StructType

    return StructType([StructField("query", LongType()), StructField("item_id", id_type)])


def _nothing(spark: SparkSession, id_type) -> DataFrame:
    empty = spark.createDataFrame([], _named(id_type))
    return empty.select("item_id", F.lit(1).alias("rank"), F.col("query").alias("doc_id"), F.col("query").alias("score"))
