"""Sequences cut into bounded chunks, and the tree that carries vectors across them.

A sequence table has ``seq_id``, an integer step ``t`` unique in the sequence, and ``obs``.
Steps are grouped into chunks of consecutive ``t``. Each chunk is summed up by a k-by-k matrix:
row i holds what the chunk does to a path that enters in state i. Matrices are multiplied up a
tree of FAN children a node, and the vectors at the ends of each node are handed down it again;
so no task sees more of a sequence than one chunk or one node's children, however long it is.
Steps are then worked out chunk by chunk. Results equal the plain step-by-step recursion.
Where every sequence has at most FAN chunks, they lie side by side in one partition, and a task works
out the ends of its chunks without the tree's shuffles: a round of a fit then moves nothing but its sums.

The steps themselves stay where their grouping put them. All arithmetic runs on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from wardline.operators.hmm import kernels
from wardline.operators.hmm.model import LOG_NEVER, Hmm
from wardline.session import shuffle_partitions

CHUNK_STEPS = 128
#: Children of a node of the tree.
FAN = 128
#: Steps that are worked out at once.
BATCH_STEPS = 1 << 16
#: Steps below which a task of a round is hardly longer than its start; partitions of fewer are taken together.
TASK_STEPS = 1 << 18
KEYS = ["seq_id", "chunk"]


@dataclass(frozen=True)
class Chunks:
    """(seq_id, chunk, t, obs, ...): at most ``chunk_steps`` ordered steps a row; ``levels`` of nodes above.

    ``together``: the chunks of a sequence, at most FAN, follow each other in one partition.
    """

    rows: DataFrame
    levels: int
    together: bool = False
    #: Steps of all sequences.
    steps: int = 0
    #: Kept runs of chunks that lie together, see :func:`kept_runs`.
    runs: RDD | None = None

    def persist(self) -> "Chunks":
        if self.together:
            return replace(self, runs=kept_runs(self.rows, self.steps))
        return replace(self, rows=self.rows.persist(StorageLevel.MEMORY_AND_DISK))

    def unpersist(self) -> None:
        (self.rows if self.runs is None else self.runs).unpersist()


def chunked(steps: DataFrame, chunk_steps: int = CHUNK_STEPS, also: Sequence[str] = ()) -> Chunks:
    """Steps as chunks; columns in ``also`` come along as lists. One short job finds the span of ``t``.

    The number of partitions is fixed: the recursions cost more than the bytes suggest, so adaptive
    execution must not merge partitions by size.
    """
    chunk = F.floor(F.col("t") / chunk_steps)
    spans = steps.groupBy("seq_id").agg(F.min(chunk).alias("low"), F.max(chunk).alias("high"), F.count(F.lit(1)).alias("n"))
    low, high, most, n = spans.agg(F.min("low"), F.max("high"), F.max(F.col("high") - F.col("low") + 1), F.sum("n")).first()
    together = most is None or most <= FAN
    levels, width = 0, 0 if low is None else high - low + 1
    while width > FAN:
        low, high, levels = low // FAN, high // FAN, levels + 1
        width = high - low + 1
    fields = ["t", "obs", *also]
    rows = (
        steps.withColumn("chunk", chunk)
        .repartition(shuffle_partitions(steps.sparkSession), *(KEYS[:1] if together else KEYS))
        .groupBy(*KEYS)
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_steps"))
        .select(*KEYS, *[F.col(f"_steps.{f}").alias(f) for f in fields])
    )
    return Chunks(rows.sortWithinPartitions(*KEYS) if together else rows, levels, together, n or 0)


@dataclass(frozen=True)
class Numbers:
    """A model as arrays. Best paths take a structural zero as LOG_NEVER, so that a path stays comparable."""

    model: Hmm
    initial: np.ndarray
    moves: np.ndarray

    @property
    def k(self) -> int:
        return self.model.k


def numbers(model: Hmm, never: float = -np.inf) -> Numbers:
    return Numbers(model, np.maximum(kernels.logs(model.initial), never), np.maximum(kernels.logs(model.transitions), never))


def path_numbers(model: Hmm) -> Numbers:
    return numbers(model, LOG_NEVER)


# Arrow lists and arrays.


def offsets_of(column: pa.ListArray) -> np.ndarray:
    at = column.offsets.to_numpy()
    return (at - at[0]).astype(np.int64)


def flat(column: pa.ListArray) -> np.ndarray:
    """The values of all lists end to end; lists of lists as rows. Missing values are NaN."""
    values = column.flatten()
    if pa.types.is_list(values.type):
        width = int(offsets_of(values)[1]) if len(values) else 0
        return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), width)
    return values.to_numpy(zero_copy_only=False)


def rows_of(column: pa.ListArray, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def lists(values: np.ndarray) -> pa.ListArray:
    """One list per row."""
    flat_values = pa.array(values.reshape(-1))
    width = values.reshape(len(values), -1).shape[1] if len(values) else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * width, pa.int32()), flat_values)


def parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose lists hold about BATCH_STEPS values."""
    ends = offsets_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(int(np.searchsorted(ends, ends[at] + BATCH_STEPS, side="right")) - 1, at + 1)
        yield batch.slice(at, to - at)
        at = to


def arrow_map(df: DataFrame, per: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType) -> DataFrame:
    """``work`` on bounded runs of the rows; ``per`` names the list column that bounds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, per):
                yield work(part)

    return df.mapInArrow(run, schema)


def sequence_map(rows: DataFrame, work: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: StructType) -> DataFrame:
    """``work`` on bounded runs of whole sequences and where each begins, for chunks that lie together.

    A sequence that a batch cuts waits for the next one. Those without an id are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            batch = batch.filter(batch.column("seq_id").is_valid())
            if batch.num_rows == 0:
                continue
            if waiting is not None:
                batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
            begins = _begins(batch)
            yield from _runs(batch.slice(0, begins[-1]), begins[:-1], work)
            waiting = batch.slice(begins[-1])
        if waiting is not None:
            yield from _runs(waiting, np.zeros(1, dtype=np.int64), work)

    return rows.mapInArrow(run, schema)


RUNS = StructType([StructField("run", BinaryType()), StructField("begins", ArrayType(LongType()))])


def kept_runs(rows: DataFrame, steps: int) -> RDD:
    """Bounded runs of whole sequences and where each begins, kept as Arrow bytes by the tasks that hold them.

    A round of a fit is then one short job over them: no query is planned and no row is turned into Arrow again.
    Its tasks go by the number of steps, at least one a core, whatever the number of partitions of the session.
    """

    def pack(batch: pa.RecordBatch, at: np.ndarray) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as stream:
            stream.write_batch(batch)
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([at], pa.list_(pa.int64()))], schema=pa.schema({"run": pa.binary(), "begins": pa.list_(pa.int64())}))

    packed = sequence_map(rows, pack, RUNS).rdd.map(lambda r: (bytes(r["run"]), np.array(r["begins"], dtype=np.int64)))
    return packed.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-steps // TASK_STEPS))).persist(StorageLevel.MEMORY_AND_DISK)


def run_sums(runs: RDD, work: Callable[[pa.RecordBatch, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``work`` over all runs, of which each task returns its part; None if there are none."""

    def fold(part: Iterator[tuple[bytes, np.ndarray]]) -> Iterator[np.ndarray]:
        sums = None
        for run, at in part:
            batch = pa.ipc.open_stream(run).read_next_batch()
            found = work(batch, at)
            sums = found if sums is None else sums + found
        if sums is not None:
            yield sums

    # one part of a fixed size for each task, added up in their order
    parts = runs.mapPartitions(fold).collect()
    return sum(parts[1:], parts[0]) if parts else None


def _begins(batch: pa.RecordBatch) -> np.ndarray:
    ids = batch.column("seq_id")
    changes = pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
    return np.append(0, np.flatnonzero(changes) + 1)


def _runs(batch: pa.RecordBatch, begins: np.ndarray, work: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if len(begins) == 0:
        return
    bounds = np.append(begins, batch.num_rows)
    ends, at = offsets_of(batch.column("t"))[bounds], 0
    while at < len(begins):
        to = max(int(np.searchsorted(ends, ends[at] + BATCH_STEPS, side="right")) - 1, at + 1)
        yield work(batch.slice(bounds[at], bounds[to] - bounds[at]), bounds[at : to + 1] - bounds[at])
        at = to


def schema_of(df: DataFrame, kept: Sequence[str], ddl: str) -> StructType:
    """Fields of ``df`` followed by new ones."""
    added = StructType.fromDDL(ddl)
    return StructType([*[StructField(c, df.schema[c].dataType) for c in kept], *added.fields])


def made(batch: pa.RecordBatch, kept: Sequence[str], added: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *added.values()], names=[*kept, *added])


# The tree.


def chunk_matrices(rows: DataFrame, n: Numbers, add: kernels.Add) -> DataFrame:
    """(seq_id, pos, m, s, n): each chunk's matrix less its largest entry, and its steps."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = offsets_of(batch.column("t"))
        lp = kernels.densities(n.model.emissions, flat(batch.column("obs")))
        m, s = kernels.chunk_matrices(lp, at, n.moves, add)
        return made(batch, ["seq_id", "pos"], {"m": lists(m), "s": pa.array(s), "n": pa.array(np.diff(at))})

    short = rows.select("seq_id", F.col("chunk").alias("pos"), "t", "obs")
    return arrow_map(short, "t", work, schema_of(short, ["seq_id", "pos"], "m array<double>, s double, n long"))


def _children(level: DataFrame, fields: Sequence[str], top: bool) -> DataFrame:
    """One row per node, or per sequence at the top: its children in order."""
    node = [] if top else [F.floor(F.col("pos") / FAN).alias("node")]
    return level.groupBy("seq_id", *node).agg(F.sort_array(F.collect_list(F.struct("pos", *fields))).alias("c"))


def _field(column: pa.ListArray, name: str) -> pa.Array:
    return column.flatten().field(name)


def matrix_levels(chunks: Chunks, n: Numbers, add: kernels.Add = kernels.log_sum) -> list[DataFrame]:
    """The chunk matrices, and above them the products of each FAN of the level below."""
    k, out = n.k, [chunk_matrices(chunks.rows, n, add)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = batch.column("c")
        m, s = kernels.products(rows_of(_field(c, "m"), k * k).reshape(-1, k, k), _field(c, "s").to_numpy(), offsets_of(c), n.moves, add)
        steps = np.add.reduceat(_field(c, "n").to_numpy(), offsets_of(c)[:-1])
        return made(batch, ["seq_id", "node"], {"m": lists(m), "s": pa.array(s), "n": pa.array(steps)})

    for _ in range(chunks.levels):
        nodes = _children(out[-1], ["m", "s", "n"], top=False)
        level = arrow_map(nodes, "c", work, schema_of(nodes, ["seq_id", "node"], "m array<double>, s double, n long"))
        out.append(level.withColumnRenamed("node", "pos"))
    return out


def totals(levels: list[DataFrame], n: Numbers, add: kernels.Add = kernels.log_sum) -> DataFrame:
    """(seq_id, total, state, n_steps): log weight of each whole sequence, and its best last state."""
    k = n.k

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = batch.column("c")
        at, groups = offsets_of(c), batch.num_rows
        m = rows_of(_field(c, "m"), k * k).reshape(-1, k, k)
        start, nowhere = np.tile(n.initial, (groups, 1)), np.zeros((groups, k), dtype=np.int64)
        done = kernels.entries(m, _field(c, "s").to_numpy(), at, n.moves, start, nowhere, add)
        added = {
            "total": pa.array(done.total + add(done.final, 1)), "state": pa.array(done.final.argmax(axis=1)),
            "n_steps": pa.array(np.add.reduceat(_field(c, "n").to_numpy(), at[:-1])),
        }
        return made(batch, ["seq_id"], added)

    tops = _children(levels[-1], ["m", "s", "n"], top=True)
    return arrow_map(tops, "c", work, schema_of(tops, ["seq_id"], "total double, state long, n_steps long"))


_ENDS = "pos long, entry array<double>, origin array<long>, ahead array<double>, is_first boolean, is_last boolean, total double, final long"


def chunk_ends(levels: list[DataFrame], n: Numbers, add: kernels.Add = kernels.log_sum) -> DataFrame:
    """(seq_id, chunk, entry, origin, ahead, is_first, is_last, total, final): the vectors at the ends of each chunk.

    ``entry`` is the log weight of each state of the chunk's first step before its observation, and
    ``origin`` the best state before it. ``ahead`` is the log weight of all past the chunk by the state
    of the step that follows; where nothing does, ``is_last`` holds. ``total`` is the log weight of the
    whole sequence and ``final`` its best last state, alike for all its chunks.
    """
    k = n.k

    def opened(batch: pa.RecordBatch, entry, origin, ahead, first, last, whole) -> pa.RecordBatch:
        c = batch.column("c")
        at = offsets_of(c)
        m, s = rows_of(_field(c, "m"), k * k).reshape(-1, k, k), _field(c, "s").to_numpy()
        down = kernels.entries(m, s, at, n.moves, entry, origin, add)
        beyond, is_last = kernels.aheads(m, at, n.moves, ahead, last)
        is_first = np.zeros(len(m), dtype=bool)
        is_first[at[:-1]] = first
        owner = np.repeat(np.arange(batch.num_rows), np.diff(at))
        total, final = whole or (down.total + add(down.final, 1), down.final.argmax(axis=1))
        added = {
            "pos": _field(c, "pos"), "entry": lists(down.entry), "origin": lists(down.origin), "ahead": lists(beyond),
            "is_first": pa.array(is_first), "is_last": pa.array(is_last), "total": pa.array(total[owner]), "final": pa.array(final[owner]),
        }
        return pa.RecordBatch.from_arrays([batch.column("seq_id").take(pa.array(owner)), *added.values()], names=["seq_id", *added])

    def from_top(batch: pa.RecordBatch) -> pa.RecordBatch:
        g = batch.num_rows
        yes, zero = np.ones(g, dtype=bool), np.zeros((g, k))
        return opened(batch, np.tile(n.initial, (g, 1)), zero.astype(np.int64), zero, yes, yes, None)

    def from_node(batch: pa.RecordBatch) -> pa.RecordBatch:
        entry, origin, ahead = (rows_of(batch.column(x), k) for x in ("entry", "origin", "ahead"))
        first, last = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("is_first", "is_last"))
        return opened(batch, entry, origin, ahead, first, last, tuple(batch.column(x).to_numpy() for x in ("total", "final")))

    tops = _children(levels[-1], ["m", "s"], top=True)
    ends = arrow_map(tops, "c", from_top, schema_of(tops, ["seq_id"], _ENDS))
    for level in reversed(levels[:-1]):
        nodes = _children(level, ["m", "s"], top=False)
        above = ends.withColumnRenamed("pos", "node")
        joined = nodes.join(above, ["seq_id", "node"]).drop("node")
        ends = arrow_map(joined, "c", from_node, schema_of(joined, ["seq_id"], _ENDS))
    return ends.withColumnRenamed("pos", "chunk")


def log_likelihoods(steps: DataFrame, model: Hmm, chunk_steps: int = CHUNK_STEPS) -> DataFrame:
    """(seq_id, n_steps, log_likelihood) by the forward recursion."""
    n = numbers(model)
    return totals(matrix_levels(chunked(steps, chunk_steps), n), n).select("seq_id", "n_steps", F.col("total").alias("log_likelihood"))


class Ends(NamedTuple):
    """What :func:`chunk_ends` finds, of the chunks of whole sequences; ``rows`` are the chunks it is of."""

    rows: pa.RecordBatch
    begins: np.ndarray
    entry: np.ndarray
    origin: np.ndarray
    ahead: np.ndarray
    is_first: np.ndarray
    is_last: np.ndarray
    total: np.ndarray
    final: np.ndarray


def ends_of(batch: pa.RecordBatch, at: np.ndarray, n: Numbers, add: kernels.Add = kernels.log_sum) -> Ends:
    """The ends of the chunks of whole sequences, which begin at ``at``. Steps without a time precede a sequence, but are no steps of it."""
    lp = kernels.densities(n.model.emissions, flat(batch.column("obs")))
    m, s = kernels.chunk_matrices(lp, offsets_of(batch.column("t")), n.moves, add)
    groups = len(at) - 1
    zero, yes = np.zeros((groups, n.k)), np.ones(groups, dtype=bool)
    down = kernels.entries(m, s, at, n.moves, np.tile(n.initial, (groups, 1)), zero.astype(np.int64), add)
    ahead, is_last = kernels.aheads(m, at, n.moves, zero, yes)
    is_first = np.zeros(len(m), dtype=bool)
    is_first[at[:-1]] = True
    owner = np.repeat(np.arange(groups), np.diff(at))
    total, final = down.total + add(down.final, 1), down.final.argmax(axis=1)
    timed = batch.column("chunk").is_valid().to_numpy(zero_copy_only=False)
    found = (down.entry, down.origin, ahead, is_first, is_last, total[owner], final[owner])
    sizes = np.bincount(owner[timed], minlength=groups)
    return Ends(batch.filter(pa.array(timed)), np.append(0, np.cumsum(sizes[sizes > 0])), *[x[timed] for x in found])


def ends_added(kept: Sequence[str], n: Numbers) -> Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]:
    """Work of :func:`sequence_map`: the columns ``kept`` and the vectors at the ends of each chunk."""

    def work(batch: pa.RecordBatch, at: np.ndarray) -> pa.RecordBatch:
        e = ends_of(batch, at, n)
        return made(e.rows, kept, {"entry": lists(e.entry), "ahead": lists(e.ahead), "is_first": pa.array(e.is_first), "is_last": pa.array(e.is_last)})

    return work


def with_ends(chunks: Chunks, n: Numbers) -> DataFrame:
    """Chunks with the vectors at their ends; only the small vectors move, and where chunks lie together nothing does."""
    if not chunks.together:
        return chunks.rows.join(chunk_ends(matrix_levels(chunks, n), n).drop("origin", "total", "final"), KEYS)
    kept = chunks.rows.columns
    schema = schema_of(chunks.rows, kept, "entry array<double>, ahead array<double>, is_first boolean, is_last boolean")
    return sequence_map(chunks.rows, ends_added(kept, n), schema)


def smoothed(batch: pa.RecordBatch, n: Numbers) -> tuple[np.ndarray, kernels.Smoothed]:
    """Observations and state shares of a batch of chunks with their ends."""
    x, at = flat(batch.column("obs")), offsets_of(batch.column("t"))
    entry, ahead = (rows_of(batch.column(c), n.k) for c in ("entry", "ahead"))
    last = batch.column("is_last").to_numpy(zero_copy_only=False)
    return x, kernels.smoothed(kernels.densities(n.model.emissions, x), at, n.moves, entry, ahead, last)
