"""Near duplicates by bottom-k sketches from one hash function.

A document's set is its distinct word shingles, hashed; its sketch the k smallest hashes.
Documents with equal sets become one class first. Inverted lists of retained values give the
overlaps; the estimate from the union of two sketches filters; full sets verify.

Which lists a class is entered in: two sets of similarity 0.85 share some 0.85 k of the k
smallest values of their union, and fewer than half of them never in practice (below 1e-10 for
k = 64; not at all where sketches are whole sets). So two such classes still meet if each is
entered only under the rarest half of its values, plus one. Values that occur once fill most of
those places, and a value in a third of all documents is used only by classes that hold little
else. Within a list, classes are first linked to one class alone, the one with the largest share
of values that others have too: among edited copies, the one nearest to what they were made from.

Lists whose classes are then in several components stay open. In these, a class is paired by its
whole set: shingles that no other component's open class holds cannot be in a link, so they take
the first places of its prefix, and the smaller of two sets needs a shorter prefix. A pair is made
only if what both sets still hold from a shared shingle on can reach the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from wardline.llm import text
from wardline.llm.components import components
from wardline.llm.scratch import written

K = 64
#: Standard deviations by which an estimate may fall short of the threshold.
SLACK = 6.0


def shingle_sets(s: text.Slice, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by row, and the distinct shingle hashes of each row in rising (signed) order."""
    low = text.Slice(s.first, text.LOWER[s.data], s.offsets)
    found = text.runs(low, text.SPACED[low.data])
    hashes = text.Hasher(low.data).ranges(found.start, found.end)
    at, gram = text.grams(hashes, found.row, words)
    row = found.row[at]
    # a row of fewer words is one shingle
    count = text.per_row(s.rows, found.row)
    for n in range(1, words):
        short = np.flatnonzero(count == n)
        if len(short):
            first = np.searchsorted(found.row, short)
            h = np.zeros(len(short), dtype=np.uint64)
            for i in range(n):
                h = text.mix(h * np.uint64(31) + hashes[first + i] + np.uint64(101 * n + i))
            row, gram = np.concatenate([row, short]), np.concatenate([gram, h])
    gram = gram.view(np.int64)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    row, gram = row[new], gram[new]
    return np.searchsorted(row, np.arange(s.rows + 1)), gram


def _mapped(docs: DataFrame, make, ddl: str, types: list[pa.DataType]) -> DataFrame:
    """Rows (id, *make(set)) of the rows (id, text)."""
    names = [x.split()[0] for x in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text.slices(batch.column(1)):
                ids = batch.column(0).slice(s.first, s.rows)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(make(s), types[1:], strict=True)]], names=names)

    return text.map_batches(docs, run, ddl)


def sketches(docs: DataFrame, words: int = 3, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch) of rows (doc_id, text); empty sets have a null digest."""

    def make(s: text.Slice):
        at, grams = shingle_sets(s, words)
        sets = [grams[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return [
            np.diff(at),
            [hashlib.blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None for g in sets],
            [g[:k] for g in sets],
        ]

    types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    return _mapped(docs, make, "doc_id long, n_shingles long, digest binary, sketch array<long>", types)


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    def make(s: text.Slice):
        at, grams = shingle_sets(s, words)
        return [[grams[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]]

    return _mapped(docs, make, "id long, grams array<long>", [pa.int64(), pa.list_(pa.int64())])


def _estimate(a: Column, b: Column, k: int) -> tuple[Column, Column]:
    """Share of the union sketch's values that both have, and the number of its values."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union), F.size(union)


def inverted_lists(classes: DataFrame) -> DataFrame:
    """(value, id, n, common) of classes (id, n, sketch): each under the rarest half of its values.

    ``common`` is the share of the class's values that other classes hold too.

    Values that only one class holds are left out, after they have taken their places.
    """
    postings = classes.select("id", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    lists = postings.groupBy("value").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    shared = postings.join(lists, "value").groupBy("id", "n", "kept").agg(F.array_sort(F.collect_list(F.struct("holders", "value"))).alias("ranked"))
    places = F.col("kept") - F.ceil(F.col("kept") / 2).cast("int") + 1
    left = places - (F.col("kept") - F.size("ranked"))
    common = (F.size("ranked") / F.col("kept")).alias("common")
    return shared.where(left > 0).select(F.explode(F.slice("ranked", F.lit(1), left)).alias("p"), "id", "n", common).select("p.value", "id", "n", "common")


def sets_of(ids: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(id, grams) of the documents that ``ids`` names; an id with several texts has several sets."""
    wanted = docs.join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    return written(_full_sets(wanted.select("doc_id", "text"), words).where(F.size("grams") > 0).distinct(), "sets")


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): every pair of rows (id, component, grams) of different components that may reach the threshold.

    Of sets of x and y >= x shingles that reach it, the smaller shares at least 2tx / (1 + t) of its
    shingles and the larger at least ty, so prefixes of the rest plus one, in one order, meet.
    """
    each = sets.select("id", "component", F.xxhash64("grams").alias("one"), F.size("grams").cast("long").alias("n"), F.explode("grams").alias("value"))
    held = each.groupBy("value").agg(F.count(F.lit(1)).alias("holders"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    across = held.where("lo < hi").select("value", "holders")
    ranked = each.join(across, "value").groupBy("id", "component", "one", "n").agg(F.array_sort(F.collect_list(F.struct("holders", "value"))).alias("ranked"))
    size = F.size("ranked")
    places = (size - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    indexed = F.col("at") < size - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1
    entries = (
        ranked.where(places > 0)
        .select("id", "component", "one", "n", "ranked", F.posexplode(F.slice("ranked", F.lit(1), places)).alias("at", "p"))
        .select("p.value", "id", "component", "one", "n", (size - F.col("at")).alias("rest"), indexed.alias("indexed"))
    )
    entries = written(entries, "entries")
    lists = entries.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(F.when(F.col("indexed"), F.col("n"))).alias("least"))
    reaches = lambda rest, sizes: rest * (100 + percent) >= sizes * percent
    useful = F.col("indexed") | reaches(F.col("rest"), F.col("n") + F.col("least"))
    entries = entries.join(lists.where("lo < hi and least is not null"), "value").where(useful).drop("lo", "hi", "least")
    x, y = (entries.select("value", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "component", "one", "n", "rest", "indexed")]) for s in "ab")
    fits = reaches(F.least("rest_a", "rest_b"), F.col("n_a") + F.col("n_b")) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    smaller = F.col("indexed_b") & ((F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("one_b") < F.col("one_a"))))
    met = x.join(y, "value").where(smaller & (F.col("component_a") != F.col("component_b")) & fits)
    return met.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, k: int, sets: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold, after the estimate from their sketches."""
    sides = [classes.select(F.col("id").alias(c), F.col("sketch").alias(f"{c}_sketch")) for c in ("a", "b")]
    share, size = _estimate(F.col("a_sketch"), F.col("b_sketch"), k)
    t = percent / 100
    near = written(
        pairs.join(sides[0], "a").join(sides[1], "b").where(share >= t - SLACK * F.sqrt(F.lit(t * (1 - t)) / size)).select("a", "b"), "near"
    )
    # rows that repeat an id with other texts: the class has the text of the set it stands for
    if sets is None:
        sets = sets_of(near.select(F.col("a").alias("id")).union(near.select("b")).distinct(), docs, words)
    both = near.join(sets.withColumnsRenamed({"id": "a", "grams": "a_grams"}), "a").join(sets.withColumnsRenamed({"id": "b", "grams": "b_grams"}), "b")
    shared = F.size(F.array_intersect("a_grams", "b_grams"))
    union = F.size("a_grams") + F.size("b_grams") - shared
    return written(both.where((shared > 0) & (shared * 100 >= union * percent)).select("a", "b").distinct(), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents link where 100 * |A & B| >= percent * |A | B|; the component is the smallest id
    that can be reached. A text without words has an empty set and links with nothing. Rows that
    repeat an id are one node with the links of all their texts. A row without an id links with
    nothing: its component_id is null and it is kept. An empty table gives an empty result; other
    columns are not read.
    """
    source = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    made = written(sketches(source, words, k), "sketches")
    sets = made.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = written(
        sets.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes"
    )
    lists = written(inverted_lists(classes), "lists")

    central = F.struct("common", -F.col("id"))
    hubs = lists.groupBy("value").agg(F.max_by("id", central).alias("hub"), F.max_by("n", central).alias("hub_n"))
    fits = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    stars = lists.join(hubs, "value").where(F.col("id") != F.col("hub")).where(fits(F.col("n"), F.col("hub_n")))
    links = verified(stars.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), classes, source, words, percent, k)

    grouped = lists.join(components(links).withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = grouped.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("value")
    named = written(grouped.join(open_, "value").select("id", "component").distinct(), "open")
    whole = sets_of(named, source, words)
    candidates = prefix_pairs(whole.join(named, "id"), percent)
    links = links.unionByName(verified(candidates, classes, source, words, percent, k, whole))

    # a document whose id stands for another of its texts, or for no class at all, hangs on its classes
    members = sets.select("doc_id", "digest").join(classes.select("digest", "id"), "digest").where(F.col("doc_id") != F.col("id")).select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    found = components(links.unionByName(members)).withColumnsRenamed({"node": "doc_id", "component": "component_id"})
    return made.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.col("doc_id").isNull() | (F.coalesce("component_id", "doc_id") == F.col("doc_id"))).alias("kept"),
    )


def keep(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest id, with the columns it came with.

    Of rows that repeat an id, the one with the least hash of its plain columns stays, so the same
    one in each run. Rows without an id all stay; an empty table stays empty.
    """
    ids = near_duplicates(docs, words=words, percent=percent).where("kept and doc_id is not null").select("doc_id").distinct()
    stay = docs.where(F.col("doc_id").isNotNull()).join(ids, "doc_id", "left_semi")
    plain = [f"`{f.name}`" for f in docs.schema if isinstance(f.dataType, AtomicType)]
    row = F.struct(*[stay[f"`{c}`"] for c in docs.columns])
    one = stay.groupBy("doc_id").agg(F.min_by(row, F.xxhash64(*plain)).alias("_row")).select("_row.*")
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
