"""Filter interaction audit over a sparse document-term matrix.

Texts are cut into shards of bounded size. A shard is a matrix in compressed rows: for each of its
rows the numbers of its words and how often each occurs, the words numbered inside the shard. The
shards' words, far fewer than the words of their texts, make one dictionary of the corpus, and each
shard's numbers are turned into the dictionary's. Sums and nonzero counts of matrix rows decide the
filters on words; flags that were taken along decide the others. Only counts per part and set of
failed filters remain then, and every order of the filters is worked out from these.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm import text
from wardline.llm.scratch import written

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
#: Bytes of text in a shard; a longer text is a shard of its own, counted in pieces of this size.
SHARD_BYTES = 4 << 20
#: The dictionary is numbered in this many buckets of words.
DICTIONARY_BUCKETS = 8192

_UPPER = np.isin(np.arange(256), list(range(ord("A"), ord("Z") + 1)))
_SYMBOL = np.isin(np.arange(256), list(b"#$%&*|"))
_POINT = (np.arange(256) & 0xC0) != 0x80  # the first byte of a character

_SHARD = pa.schema(
    [
        ("ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())), ("digests", pa.list_(pa.binary())), ("flags", pa.list_(pa.int32())),
        ("indptr", pa.binary()), ("indices", pa.binary()), ("counts", pa.binary()), ("words", pa.list_(pa.binary())), ("buckets", pa.list_(pa.int32())),
    ]
)
_SHARD_DDL = (
    "ids array<long>, parts array<string>, digests array<binary>, flags array<int>, "
    "indptr binary, indices binary, counts binary, words array<binary>, buckets array<int>"
)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: differences, their bytes by place, compressed."""
    steps = np.diff(values.astype("<i8"), prepend=0)
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T), 1)


def unpack(packed: bytes) -> np.ndarray:
    """The numbers that ``pack`` was given."""
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view("<i8"))


def _row_sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _distinct(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of one text's piece and how often each occurs."""
    counted = words.value_counts()
    return counted.field("values"), counted.field("counts").to_numpy()


def _counted(keys: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs, each occurrence as often as ``times`` says."""
    if times is None:
        return np.unique(keys, return_counts=True)
    known, back = np.unique(keys, return_inverse=True)
    return known, np.bincount(back, times, minlength=len(known)).astype(np.int64)


def _buckets(words: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    raw = words.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[: offsets[-1]] if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    return (text.Hasher(data).ranges(offsets[:-1], offsets[1:]) % np.uint64(DICTIONARY_BUCKETS)).astype(np.int32)


def _shard(s: text.Slice, most: int) -> dict:
    """One shard's matrix and flags, as one row's values."""
    found = []
    upper, points, symbols = (np.zeros(s.rows, dtype=np.int64) for _ in range(3))
    for piece in text.pieces(s, text.SPACED, most):
        row, words = text.word_array(piece, text.SPACED)
        found.append((row, words, None) if len(s.data) <= most else (row[:0], *_distinct(words)))
        for sums, table in ((upper, _UPPER), (points, _POINT), (symbols, _SYMBOL)):
            sums += _row_sums(table[piece.data], piece.offsets)
    if len(found) == 1:
        row, words, times = found[0]
    else:
        words, times = pa.concat_arrays([w for _, w, _ in found]), np.concatenate([n for *_, n in found])
    if times is not None:  # one text
        row = np.zeros(len(words), dtype=np.int64)
    coded = words.dictionary_encode()
    known = coded.dictionary
    # by bucket and word, as the dictionary is
    buckets = _buckets(known)
    order = pc.sort_indices(pa.table({"b": buckets, "w": known}), sort_keys=[("b", "ascending"), ("w", "ascending")])
    place = np.empty(len(known), dtype=np.int64)
    place[order.to_numpy()] = np.arange(len(known))
    size = max(len(known), 1)
    key, counts = _counted(row * size + place[coded.indices.to_numpy()], times)
    raw = s.data.tobytes()
    flags = (100 * upper > MAX_UPPER_PERCENT * points) * 4 + (symbols > 0) * 8
    return {
        "digests": [hashlib.sha256(raw[a:b]).digest() for a, b in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist(), strict=True)],
        "flags": flags.astype(np.int32),
        "indptr": pack(np.searchsorted(key // size, np.arange(s.rows + 1))),
        "indices": pack(key % size),
        "counts": pack(counts),
        "words": known.take(order),
        "buckets": buckets[order.to_numpy()],
    }


def _one_row(value, kind: pa.DataType) -> pa.Array:
    if isinstance(value, bytes):
        return pa.array([value], kind)
    values = value.cast(kind.value_type) if isinstance(value, pa.Array) else pa.array(value, kind.value_type)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def local_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(shard, ids, parts, digests, flags, indptr, indices, counts, words, buckets): matrices with their own words.

    Row r of a shard has the entries indptr[r] to indptr[r + 1], in order of their words; the three
    lists of numbers are packed. ``words`` are numbered from 0 by their place, which goes by bucket and
    word. ``flags`` holds 4 where C fails and 8 where D does, ``digests`` the SHA-256 of the text.
    """
    source = docs.select(
        docs[f"`{id_col}`"].cast("long").alias("id"),
        F.coalesce(docs[f"`{part_col}`"].cast("string"), F.lit("")).alias("part"),
        docs[f"`{text_col}`"].alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text.slices(batch.column(2), shard_bytes):
                here = batch.slice(s.first, s.rows)
                made = _shard(s, shard_bytes) | {"ids": here.column(0), "parts": here.column(1)}
                yield pa.RecordBatch.from_arrays([_one_row(made[f.name], f.type) for f in _SHARD], schema=_SHARD)

    return text.map_batches(source, run, _SHARD_DDL).withColumn("shard", F.monotonically_increasing_id())


def document_term_matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The matrix in shards whose ``indices`` are word numbers, and the dictionary (word, word_id).

    A word's number is its bucket and its rank in the bucket. The words of a shard are in the same
    order, so their numbers, sorted, are the numbers of its places. The matrix also has the sum and the
    number of entries of each row (n_words, n_distinct). What moves are each shard's distinct
    words, their numbers and its matrix, never texts or single occurrences; a word meets itself once
    per shard, in a window that spills. The matrix of local numbers is in the shared folder.
    """
    local = written(local_shards(docs, id_col, text_col, part_col, shard_bytes), "matrix")
    held = local.select("shard", F.explode(F.arrays_zip("buckets", "words")).alias("w")).select("shard", F.col("w.buckets").alias("bucket"), F.col("w.words").alias("word"))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word"))
    numbered = held.select("shard", "word", (F.shiftleft(F.col("bucket").cast("long"), 32) + rank).alias("word_id"))
    dictionary = numbered.select("word", "word_id").distinct()
    # dealt by shard as plain rows: gathering lists before would sort them first
    coded = numbered.select("shard", "word_id").repartition("shard").groupBy("shard").agg(F.sort_array(F.collect_list("word_id")).alias("word_ids"))
    joined = local.drop("words", "buckets").join(coded, "shard", "left")
    carried = ["shard", "ids", "parts", "digests", "flags", "indptr", "counts"]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                at, places, counts = (unpack(row.column(c)[0].as_py()) for c in ("indptr", "indices", "counts"))
                ids = row.column("word_ids").flatten().to_numpy()
                total = np.concatenate([[0], np.cumsum(counts)])
                made = {"indices": pack(ids[places] if len(ids) else places), "n_words": total[at[1:]] - total[at[:-1]], "n_distinct": np.diff(at)}
                kinds = {"indices": pa.binary(), "n_words": pa.list_(pa.int64()), "n_distinct": pa.list_(pa.int64())}
                columns = [row.column(c) for c in carried] + [_one_row(v, kinds[c]) for c, v in made.items()]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, *made])

    ddl = (
        "shard long, ids array<long>, parts array<string>, digests array<binary>, flags array<int>, indptr binary, counts binary, "
        "indices binary, n_words array<long>, n_distinct array<long>"
    )
    return text.map_batches(joined.select(*carried, "indices", "word_ids"), turn, ddl), dictionary


def matrix_rows(matrix: DataFrame) -> DataFrame:
    """(id, part, digest, failed, n_words, n_distinct) of each document, from the sums of its matrix row.

    ``failed`` holds 1, 2, 4 and 8 where A, B, C and D fail.
    """
    rows = matrix.select(F.explode(F.arrays_zip("ids", "parts", "digests", "flags", "n_words", "n_distinct")).alias("r")).select(
        F.col("r.ids").alias("id"), F.col("r.parts").alias("part"), F.col("r.digests").alias("digest"), F.col("r.flags").cast("long").alias("flags"),
        F.col("r.n_words").alias("n_words"), F.col("r.n_distinct").alias("n_distinct"),
    )
    few = F.when(F.col("n_words") < MIN_WORDS, 1).otherwise(0)
    repeated = F.when(100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"), 2).otherwise(0)
    return rows.select("id", "part", "digest", (F.col("flags") + few + repeated).alias("failed"), "n_words", "n_distinct")


def with_copies(rows: DataFrame) -> DataFrame:
    """Adds 16 to ``failed`` where a smaller id has the same text.

    The least id of a text joins on text and id together, so the copies of one text stay spread.
    """
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).where(F.col("id").isNotNull())
    joined = rows.join(first.withColumn("_first", F.lit(True)), ["digest", "id"], "left")
    again = F.col("_first").isNull() & F.col("id").isNotNull()
    return joined.withColumn("failed", F.col("failed") + F.when(again, 16).otherwise(0)).drop("_first")


def steps(filters: str = FILTERS) -> list[dict]:
    """All orders with their steps: the bits of the step's filter and of those before it."""
    out = []
    for order in itertools.permutations(filters):
        for i, f in enumerate(order):
            bits = [1 << filters.index(x) for x in order[: i + 1]]
            out.append({"filter_order": "".join(order), "step": i + 1, "own": bits[-1], "before": sum(bits[:-1])})
    return out


def interactions(flagged: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, ...) from rows of (part, failed, good, toxic).

    The rows are counted by part and set of failed filters, at most 32 counts a part; each step of
    each order, and the sum over all orders, is a sum over these.
    """
    counts = flagged.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good"), F.sum(F.col("toxic").cast("long")).alias("toxic")
    )
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("c"))
    table = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order:string,step:int,own:long,before:long>>")
    rows = per_part.select("part", "c", F.explode(table).alias("s")).select("part", "c", "s.*")

    def total(value: str, keep) -> Column:
        return F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + F.when(keep(x["failed"]), x[value]).otherwise(0))

    own, before = F.col("own"), F.col("before")

    def fails(x: Column) -> Column:
        return x.bitwiseAND(own) > 0

    def here(x: Column) -> Column:
        return fails(x) & (x.bitwiseAND(before) == 0)

    share = F.array(*[F.lit(120 // k) for k in range(1, 6)])
    # a filter comes first of the k that a document fails in a k-th of all orders
    orders = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + F.when(fails(x["failed"]), x["n"] * F.element_at(share, F.bit_count(x["failed"]))).otherwise(0))
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda x: x.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda x: fails(x) & (x.bitwiseAND(before) > 0)).alias("redundant"),
        total("n", lambda x: x == own).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        orders.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """What each filter removes, in every order of the five, per part.

    A null text is empty and a null part is the empty string. Repeated rows count each; rows that
    share an id and a text are no copies of one another, and a row without an id neither is nor has
    a copy. An id labelled more than once is good or toxic if one of its labels says so; labels
    without an id are left out. An empty table gives no rows. Other columns are not read.
    """
    matrix, _ = document_term_matrix(docs, id_col, text_col, part_col, shard_bytes)
    rows = written(matrix_rows(matrix), "rows")
    known = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    )
    flagged = with_copies(rows).join(known, "id", "left")
    return interactions(flagged.select("part", "failed", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]))
