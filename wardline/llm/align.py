"""Line dedup by pairwise alignment.

Documents that overlap are found in three ways. Exact copies lead to the first document with
their text. Each line that a document holds leads to the first document with that line, and the
lines' rarity adds up over the pair. Each run of shared lines that is rare or long enough to make
a pair alone leads to the first document with that run and, as long as alignment leaves a line of
it in place, to some later ones that come before the document. Pairs are aligned by patience diff,
and the common blocks go from the later document. Of a run that is still in place then, the block
is aligned with the same block of its first holder, where all lines match. A document with a
shorter shared block in place at last meets the few earlier holders of its rare lines.

Rarity, bytes and words of a run don't depend on the number of documents, so two documents are
cleaned alike in a small table and in a large one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm import text
from wardline.llm.scratch import written

#: Shorter lines find no pairs; in a common block they go with the rest.
MIN_LINE_BYTES = 16
#: Rarity that a pair's shared lines must add up to. A line that n texts hold has 1 / log2(n), so
#: one that two hold has 1, and a line of up to four makes a pair alone. Copies count as one text.
MIN_WEIGHT = 0.5
#: A run of so many words makes a pair however many documents hold it.
MIN_WORDS = 8
#: Common blocks of fewer bytes stay.
MIN_BLOCK_BYTES = 40
#: Rounds in which a run that is still in place tries one more holder; then its block goes alone.
SINGLE_ROUNDS = 4


def line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, version, lines, sizes, words) of rows (doc_id, version, text): hashes, bytes and words by line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text.slices(batch.column(2)):
                found = text.lines(s)
                hashes = text.Hasher(s.data).ranges(found.start, found.end).view(np.int64)
                sizes = (found.end - found.start).astype(np.int32)
                starts = text.runs(s, text.SPACED[s.data]).start
                words = (np.searchsorted(starts, found.end) - np.searchsorted(starts, found.start)).astype(np.int32)
                offsets = pa.array(np.searchsorted(found.row, np.arange(s.rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(s.first, s.rows), batch.column(1).slice(s.first, s.rows),
                        *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (hashes, sizes, words)],
                    ],
                    names=["doc_id", "version", "lines", "sizes", "words"],
                )

    return text.map_batches(docs, run, "doc_id long, version long, lines array<long>, sizes array<int>, words array<int>")


def windows(
    lines: list[int], sizes: list[int], words: list[int], weights: dict[int, float],
    min_weight: float = MIN_WEIGHT, min_line_bytes: int = MIN_LINE_BYTES, min_block_bytes: int = MIN_BLOCK_BYTES,
) -> list[tuple[int, int]]:
    """First and last positions of the least runs of shared lines that make a pair alone.

    ``weights`` has the lines that other documents hold too; shorter lines may stand between them.
    A run counts with enough bytes and either the rarity or the words. From each line the least
    run forward and backward is taken, so each line of a longer common block is in one of them,
    and what is taken of a block does not depend on the lines around it.
    """
    out: set[tuple[int, int]] = set()
    n, a = len(lines), 0
    while a < n:
        b = a
        while b < n and (sizes[b] < min_line_bytes or lines[b] in weights):
            b += 1
        ends: list[int] = []
        held: Counter[int] = Counter()
        size = count = 0
        weight = 0.0
        e = a
        for i in range(a, b):
            while e < b and not (size >= min_block_bytes and (weight >= min_weight or count >= MIN_WORDS)):
                size, count = size + sizes[e], count + words[e]
                held[lines[e]] += 1
                if held[lines[e]] == 1:
                    weight += weights.get(lines[e], 0.0)
                e += 1
            if not (size >= min_block_bytes and (weight >= min_weight or count >= MIN_WORDS)):
                break
            ends.append(e - 1)
            out.add((i, e - 1))
            size, count = size - sizes[i], count - words[i]
            held[lines[i]] -= 1
            if held[lines[i]] == 0:
                weight -= weights.get(lines[i], 0.0)
        if ends:
            out.update((a + bisect_right(ends, k) - 1, k) for k in range(ends[0], b))
        a = b + 1
    return sorted(out)


def meetings(lines: DataFrame, min_weight: float = MIN_WEIGHT, min_line_bytes: int = MIN_LINE_BYTES) -> DataFrame:
    """(doc_id, version, firsts, rare, runs) of the texts that share a line, one row for exact copies.

    ``firsts`` are the earlier documents that the text's lines lead to with enough rarity in all,
    or with two shared lines or more that make up half of the text's, or with all of them. Each
    line leads to one of them only, so a line that very many documents hold brings one row for
    each. ``rare`` are the lines that make a pair alone. ``runs`` are the text's windows: (run,
    start, end, alone) with the hash of the lines; those that are not ``alone`` have the bytes of
    a block only.
    """
    one = F.filter(F.arrays_zip("lines", "sizes"), lambda x: x["sizes"] >= min_line_bytes)
    told = lines.select("doc_id", "version", F.array_distinct(F.transform(one, lambda x: x["lines"])).alias("own"))
    each = told.select("doc_id", "version", F.explode("own").alias("line"))
    held = each.groupBy("line").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("holders"))
    # two texts at least, since first < last
    weighed = held.where("first < last").select("line", "first", (1 / F.log2("holders")).alias("weight"))
    met = each.join(weighed, "line").groupBy("doc_id", "version").agg(F.collect_list(F.struct("line", "first", "weight")).alias("met"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, rares, at, keys, starts, ends, alone = [], [], [0], [], [], [], []
            for i in range(batch.num_rows):
                own, sizes, words = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("lines", "sizes", "words"))
                shared = batch.column("met")[i].values
                line, first, weight = (shared.field(c).to_pylist() for c in ("line", "first", "weight"))
                doc = batch.column("doc_id")[i].as_py()
                sums: dict[int, float] = {}
                for f, w in zip(first, weight, strict=True):
                    sums[f] = sums.get(f, 0.0) + w
                times = Counter(first)
                n_own = len(np.unique(own[sizes >= min_line_bytes]))
                enough = [f for f in sums if f < doc and (sums[f] >= min_weight or times[f] == n_own or (times[f] > 1 and times[f] * 2 >= n_own))]
                firsts.append(enough)
                rares.append([x for x, w in zip(line, weight, strict=True) if w >= min_weight])
                of_doc = own.tolist(), sizes.tolist(), words.tolist(), dict(zip(line, weight, strict=True))
                strong = set(windows(*of_doc, min_weight, min_line_bytes))
                found = sorted(strong.union(windows(*of_doc, 0.0, min_line_bytes)))
                if found:
                    alone.append(np.array([x in strong for x in found]))
                    start, end = np.array(found).T
                    keys.append(text.run_hashes(own.view(np.uint64), start, end + 1).view(np.int64))
                    starts.append(start)
                    ends.append(end)
                at.append(at[-1] + len(found))
            runs = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, t), *x]).astype(t)) for x, t in ((keys, np.int64), (starts, np.int32), (ends, np.int32), (alone, bool))],
                names=["run", "start", "end", "alone"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("version"), pa.array(firsts, pa.list_(pa.int64())), pa.array(rares, pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs),
                ],
                names=["doc_id", "version", "firsts", "rare", "runs"],
            )

    return met.join(lines, ["doc_id", "version"]).select("doc_id", "version", "lines", "sizes", "words", "met").mapInArrow(
        run, "doc_id long, version long, firsts array<long>, rare array<long>, runs array<struct<run:long,start:int,end:int,alone:boolean>>"
    )


def _rising(values: list[int]) -> list[int]:
    """Positions of a longest rising run of values."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before[i] = ends[k - 1] if k else -1
        if k == len(tails):
            tails.append(v)
            ends.append(i)
        else:
            tails[k], ends[k] = v, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions of two lists of lines, rising in both.

    Equal ends match first; then lines that are unique in both anchor the parts between them, in
    their longest common order, and each part is aligned in turn.
    """
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and in_b.get(x) == 1}
        common = [(place[x], j) for j, x in enumerate(b[b0:b1], b0) if x in place]
        if not common:
            continue
        i0, j0 = a0, b0
        for k in _rising([i for i, _ in common]):
            i, j = common[k]
            matched.append((i, j))
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, a1, j0, b1))
    return sorted(matched)


def common_blocks(a: list[int], b: list[int], sizes: list[int], min_block_bytes: int = MIN_BLOCK_BYTES) -> list[int]:
    """Positions in ``b`` of the aligned blocks that hold enough bytes, line ends not counted."""
    out: list[int] = []
    block: list[int] = []
    last = None
    for i, j in [*patience(a, b), (-9, -9)]:
        if last is not None and (i, j) != (last[0] + 1, last[1] + 1):
            if sum(sizes[x] for x in block) >= min_block_bytes:
                out += block
            block = []
        block.append(j)
        last = (i, j)
    return out


def removed_lines(lines: DataFrame, found: DataFrame, min_block_bytes: int = MIN_BLOCK_BYTES) -> DataFrame:
    """(doc_id, version, removed): line numbers from 0 that go from each later document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for i in range(batch.num_rows):
                earlier, later, sizes = (batch.column(c)[i].as_py() for c in ("earlier", "lines", "sizes"))
                gone.append(common_blocks(earlier, later, sizes, min_block_bytes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), pa.array(gone, pa.list_(pa.int32()))], names=["doc_id", "version", "gone"]
            )

    later = found.join(lines.select("doc_id", "version", "lines", "sizes"), ["doc_id", "version"])
    # every text of the earlier document counts
    both = later.join(lines.select(F.col("doc_id").alias("first"), F.col("lines").alias("earlier")), "first")
    each = both.select("doc_id", "version", "lines", "sizes", "earlier").mapInArrow(run, "doc_id long, version long, gone array<int>")
    return _united(each.where(F.size("gone") > 0).withColumnRenamed("gone", "removed"))


def _united(gone: DataFrame) -> DataFrame:
    return gone.groupBy("doc_id", "version").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("removed")))).alias("removed"))


def overlaps(lines: DataFrame) -> DataFrame:
    """(doc_id, version, removed) over all documents that an earlier one overlaps."""
    first_of = lines.groupBy("version").agg(F.min("doc_id").alias("first"))
    copies = written(lines.select("doc_id", "version").join(first_of, "version").where("doc_id > first"), "copies")
    texts = lines.join(copies, ["doc_id", "version"], "left_anti")
    met = written(meetings(texts), "meetings")
    runs = met.select("doc_id", "version", F.inline("runs"))
    held = runs.groupBy("run").agg(F.min("doc_id").alias("tried"), F.max("doc_id").alias("last")).where("tried < last").drop("last")
    shared = written(runs.join(held, "run"), "runs")
    open_runs = shared.where("alone and doc_id > tried")
    by_line = met.select("doc_id", "version", F.explode("firsts").alias("first"))
    by_run = open_runs.select("doc_id", "version", F.col("tried").alias("first"))
    found = written(by_line.unionByName(by_run).distinct(), "pairs")
    gone = written(removed_lines(lines, copies.select("doc_id", "version", "first").unionByName(found)), "removed")
    for _ in range(SINGLE_ROUNDS):
        left = _in_place(open_runs, gone)
        holders = shared.where("alone").select("run", F.col("doc_id").alias("first"))
        holders = holders.join(left.groupBy("run").agg(F.min("tried").alias("before")), "run").where("first > before")
        holders = holders.groupBy("run").agg(F.min("first").alias("first"))
        open_runs = written(left.join(holders, "run").where("first < doc_id").drop("tried").withColumnRenamed("first", "tried"), "runs")
        if open_runs.isEmpty():
            break
        more = open_runs.select("doc_id", "version", F.col("tried").alias("first")).distinct()
        gone = written(_united(gone.unionByName(removed_lines(lines, more))), "removed")
        found = found.unionByName(more)
    # the block of such a run and that of its first holder are equal lists, which match in full
    blocks = _in_place(shared.where("alone and doc_id > tried"), gone).select("doc_id", "version", F.sequence("start", "end").alias("removed"))
    gone = written(_united(gone.unionByName(blocks)), "removed")
    # a rare line has at most four holders
    left = written(_in_place(shared.where("doc_id > tried"), gone).select("doc_id", "version", "run"), "runs")
    rare = met.select("doc_id", "version", F.explode("rare").alias("line"))
    later = rare.join(left.select("doc_id", "version").distinct(), ["doc_id", "version"], "left_semi")
    earlier = rare.select("line", F.col("doc_id").alias("first")).distinct()
    by_rare = later.join(earlier, "line").where("first < doc_id").select("doc_id", "version", "first").distinct()
    by_rare = by_rare.join(found, ["doc_id", "version", "first"], "left_anti")
    of_first = shared.select("run", F.col("doc_id").alias("first"))
    more = by_rare.join(left, ["doc_id", "version"]).join(of_first, ["run", "first"], "left_semi").select("doc_id", "version", "first").distinct()
    return _united(gone.unionByName(removed_lines(lines, written(more, "pairs"))))


def _in_place(runs: DataFrame, gone: DataFrame) -> DataFrame:
    """The runs with a line that does not go."""
    stays = F.expr("removed is null or exists(sequence(start, end), i -> not array_contains(removed, i))")
    return runs.join(gone, ["doc_id", "version"], "left").where(stays).drop("removed")


def _version(body: Column) -> Column:
    return F.xxhash64(body)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with n_lines, removed (line numbers from 0) and kept_text, which replaces no column.

    Columns of ``docs`` are kept under ``row``. Lines are split at line ends only and compared as
    they are. A null text has no lines and stays null; an empty one has one empty line. Rows that
    repeat an id take nothing from each other, and rows without an id neither give nor lose lines.
    A text all of whose lines go is kept as an empty one.
    """
    # whole rows travel once, to the line numbers that go from them
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    body = F.col("row")[text_col]
    keyed = rows.select("row", F.col("row")[id_col].cast("long").alias("doc_id"), _version(body).alias("version"))
    source = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text")).where("doc_id is not null and text is not null")
    lines = written(line_table(source.select("doc_id", _version(F.col("text")).alias("version"), "text")).dropDuplicates(["doc_id", "version"]), "lines")
    gone = overlaps(lines)
    split = F.split(body, "\n", -1)
    rest = F.array_join(F.filter(split, lambda x, i: ~F.array_contains("removed", i)), "\n")
    return keyed.join(gone, ["doc_id", "version"], "left").select(
        "row",
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.when(F.col("removed").isNull(), body).otherwise(rest).alias("kept_text"),
    )


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents without the lines that go; those left without a word go too.

    A text that had no word before stays as it was, a null one too. The columns are those of
    ``docs``, whatever their names. Rows that repeat an id take nothing from each other and all
    stay, as do rows without an id; an empty table stays empty.
    """
    done = dedup(docs, text_col=text_col)
    stays = (F.size("removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    return done.where(stays).select(*[(F.col("kept_text") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
