"""Sequence packing by cutting-stock column generation.

Documents are tokenised once and cut into full blocks and one remainder. The histogram of piece
lengths, which has at most as many rows as a sequence has tokens, is the demand of a cutting
stock problem: a linear program over patterns whose columns are priced by an unbounded knapsack.
Rounded down patterns take most pieces, best fit the few that are left. Pieces are then ranked
within their length and take the places of the patterns in turn.
"""

from __future__ import annotations

import base64
import json
import math
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.numbering import number
from wardline.llm.scratch import written
from wardline.llm.text import map_batches

CAPACITY = 1024
END_ID = 0
#: A length's pieces are ranked in this many buckets.
RANK_BUCKETS = 1024
#: Texts are tokenised in parts of about this many characters.
PART_CHARS = 1 << 20
_CUT = re.compile(r"(?<=\S) (?=\S)")
PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@cache
def _specials(vocabulary: str) -> list[str]:
    """The strings of the vocabulary's special tokens."""
    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"] if t["special"]]


@cache
def _exact(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


@cache
def _fast(ranks: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def _parts(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """Cut before single blanks between two other characters, where the vocabulary's words end anyway."""
    at = 0
    while len(text) - at > most and (cut := _CUT.search(text, at + most)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def token_ids(text: str, vocabulary: str, ranks: str) -> Iterator[np.ndarray]:
    """Ids of a text in runs. Texts that hold a special token's string take the slower encoder."""
    special = _specials(vocabulary)
    for part in _parts(text):
        if any(s in part for s in special):
            yield np.array(_exact(vocabulary).encode(part, add_special_tokens=False).ids, dtype="<u4")
        else:
            yield np.array(_fast(ranks).encode_to_numpy(part), dtype="<u4")


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    vocabulary: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken", with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and an end id, cut into blocks of ``capacity`` and a remainder.

    A null or empty text is the end id alone. Rows that repeat an id are pieces of their own.
    ``with_ids`` adds the ids themselves.
    """
    ddl = PIECE_DDL + (", ids array<int>" if with_ids else "")

    def cut(doc, text: str) -> Iterator[tuple]:
        held = [*token_ids(text or "", vocabulary, ranks), np.array([END_ID], dtype="<u4")]
        ids = np.concatenate(held)
        for at in range(0, len(ids), capacity):
            piece = ids[at : at + capacity]
            yield (doc, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), *([piece.astype(np.int32)] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ddl.split(", ")]
        types = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                rows = [p for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for p in cut(d, t)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return map_batches(docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text")), run, ddl)


def _knapsack(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Lengths 1..capacity with values: the best filling, each length any number of times."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, dtype=np.int64)
    for w in range(1, capacity + 1):
        total = value[1 : w + 1] + best[w - 1 :: -1][:w]
        i = int(np.argmax(total))
        if total[i] > best[w - 1] + 1e-12:
            best[w], took[w] = total[i], i + 1
        else:
            best[w] = best[w - 1]
    counts = np.zeros(capacity + 1, dtype=np.int64)
    w = capacity
    while w > 0:
        if took[w]:
            counts[took[w]] += 1
            w -= took[w]
        else:
            w -= 1
    return float(best[capacity]), counts


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing over a list of lengths."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    for length in sorted(lengths, reverse=True):
        room = next((r for r in range(length, capacity + 1) if by_room[r]), None)
        if room is None:
            bins.append([])
            b, room = len(bins) - 1, capacity
        else:
            b = by_room[room].pop()
        bins[b].append(length)
        by_room[room - length].append(b)
    return bins


def _first_patterns(demand: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int], float]]:
    """(length, pattern, use) of first-fit-decreasing patterns that meet the demand; one per length.

    A pattern is used until one of its lengths is met, and no later pattern has that length: so
    in this order the patterns are the columns of a triangular basis.
    """
    left = {s: float(demand[s]) for s in sorted(demand, reverse=True)}
    out = []
    while open_ := [s for s in left if left[s]]:
        room, pattern = capacity, {}
        for s in open_:
            if n := min(room // s, math.ceil(left[s])):
                pattern[s] = n
                room -= n * s
        times = min(left[s] / n for s, n in pattern.items())
        for s, n in pattern.items():
            left[s] = rest if (rest := left[s] - n * times) > 1e-9 else 0
        met = [s for s in pattern if not left[s]]
        out.append((met[0], pattern, times))
        out += [(s, {s: capacity // s}, 0.0) for s in met[1:]]
    return out


def column_generation(demand: dict[int, int], capacity: int, gap: float = 0.0005, most_rounds: int = 300) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Patterns with their fractional use that meet each demand exactly, and a lower bound.

    Revised simplex from first-fit patterns. Each round prices a new pattern by knapsack and
    exchanges it for one in the basis. It ends when no pattern helps, or when the use is within
    ``gap`` of the bound (the greater of total length / capacity and Farley's), or after
    ``most_rounds``; what it has then meets the demand all the same.
    """
    sizes = np.array(sorted(demand))
    need = np.array([demand[s] for s in sizes], dtype=float)
    if not len(sizes):
        return [], 0.0
    first = _first_patterns(demand, capacity)
    at = {s: i for i, s in enumerate(sizes.tolist())}
    columns, inverse = np.zeros((2, len(sizes), len(sizes)))
    use = np.array([times for *_, times in first])
    for j, (_, pattern, _) in enumerate(first):
        for s, n in pattern.items():
            columns[at[s], j] = n
    for j, (s, pattern, _) in enumerate(first):
        earlier = np.flatnonzero(columns[at[s], :j])
        inverse[j, at[s]] = 1.0
        inverse[j] -= (columns[at[s], earlier, None] * inverse[earlier]).sum(axis=0)
        inverse[j] /= pattern[s]
    bound = float((sizes * need).sum()) / capacity
    for _ in range(most_rounds):
        if use.sum() <= bound * (1 + gap):
            break
        value = np.full(capacity + 1, -1.0)
        value[sizes] = inverse.sum(axis=0)
        worth, counts = _knapsack(value, capacity)
        if worth <= 1 + 1e-9:
            bound = max(bound, float(use.sum()))
            break
        bound = max(bound, float(use.sum()) / worth)
        entering = counts[sizes].astype(float)
        some = np.flatnonzero(entering)
        step = (inverse[:, some] * entering[some]).sum(axis=1)
        up = np.flatnonzero(step > 1e-9)
        ratio = use[up] / step[up]
        out = up[np.argmin(ratio)]
        theta = use[out] / step[out]
        use = np.maximum(use - theta * step, 0.0)
        use[out] = theta
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        columns[:, out] = entering
    patterns = [({int(sizes[i]): int(columns[i, j]) for i in np.flatnonzero(columns[:, j])}, float(use[j])) for j in np.flatnonzero(use > 1e-9)]
    return patterns, bound


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Whole patterns, (pieces by length, times), that use up the histogram exactly."""
    left = dict(histogram)
    out = []
    # a length that fills a sequence alone needs no program
    if left.pop(capacity, 0):
        out.append(({capacity: 1}, histogram[capacity]))
    for pattern, use in column_generation({k: v for k, v in left.items() if v}, capacity)[0]:
        times = min([int(use + 1e-6), *(left[k] // n for k, n in pattern.items())])
        if times:
            out.append((pattern, times))
            for k, n in pattern.items():
                left[k] -= n * times
    rest = best_fit([k for k, n in left.items() for _ in range(n)], capacity)
    return out + [({k: b.count(k) for k in set(b)}, 1) for b in rest]


def assign(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece its sequence_id and offset; the sequence ids have no gaps.

    The driver sees the histogram, at most ``capacity`` rows, and returns the places of each
    length in the patterns: rows as bounded as the basis of the linear program.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places, sequence, ranked = [], 0, dict.fromkeys(histogram, 0)
    for pattern, times in plan(histogram, capacity):
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            places.append((length, ranked[length], ranked[length] + n * times, n, sequence, offset))
            ranked[length] += n * times
            offset += n * length
        sequence += times
    table = spark.createDataFrame(places, "length long, _from long, _to long, _each long, _sequence long, _offset long")
    numbered = number(cut, "length", ["doc_id", "start", "ids_crc32"], "_rank", RANK_BUCKETS)
    turn = F.col("_rank") - F.col("_from")
    joined = numbered.join(F.broadcast(table), (numbered["length"] == table["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return joined.select(
        *[cut[c] for c in cut.columns],
        (F.col("_sequence") + F.floor(turn / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (turn % F.col("_each")) * numbered["length"]).alias("offset"),
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; tokens are written once and read again.

    An empty table gives no pieces. Extra columns are left out, so no name can clash.
    """
    return assign(written(pieces(docs, id_col, text_col, capacity, with_ids=with_ids), "pieces"), capacity)
