"""Counterfactual-regularised toxicity classifier.

A logistic model over the words of a text and the beginnings of its words. Where a labelled
text names a group, its identity terms are swapped for others of the same kind, and the model
pays for each change of score that the swap alone brings; so naming a group does not by itself
make a text toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from wardline.llm import text

#: Terms of one row can stand for one another.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "natives"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)
PREFIXES = (4, 5, 6)
#: Labelled texts that training reads at most, by rising hash of the id.
MAX_TRAINING = 12_000
#: Features that the model keeps, by likelihood ratio.
MAX_FEATURES = 20_000
MIN_COUNT = 3
_TABLE_BITS = 20


def features(s: text.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word and word beginning, repeats included."""
    low = text.Slice(s.first, text.LOWER[s.data], s.offsets)
    words = text.runs(low, text.ALNUM[low.data])
    hasher = text.Hasher(low.data)
    rows, found = [words.row], [hasher.ranges(words.start, words.end)]
    for k in PREFIXES:
        long = words.end - words.start > k
        rows.append(words.row[long])
        found.append(text.mix(hasher.ranges(words.start[long], words.start[long] + k) + np.uint64(k)))
    return np.concatenate(rows), np.concatenate(found)


def swapper(groups: tuple[tuple[str, ...], ...]):
    """A function that puts each identity term's neighbour in its row in its place."""
    following = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    pattern = re.compile(r"\b(" + "|".join(sorted(map(re.escape, following), key=len, reverse=True)) + r")\b", re.IGNORECASE)
    return lambda t: pattern.sub(lambda m: following[m[0].lower()], t)


@dataclass(frozen=True)
class Model:
    known: np.ndarray  # sorted features
    weights: np.ndarray
    bias: float

    def logits(self, s: text.Slice) -> np.ndarray:
        total = np.full(s.rows, self.bias)
        if not len(self.known) or not len(s.data):
            return total
        row, found = features(s)
        table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        table[self.known >> np.uint64(64 - _TABLE_BITS)] = True
        maybe = table[found >> np.uint64(64 - _TABLE_BITS)]
        row, found = row[maybe], found[maybe]
        place = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
        hit = self.known[place] == found
        pairs = np.unique(row[hit].astype(np.int64) * len(self.known) + place[hit])
        return total + np.bincount(pairs // len(self.known), self.weights[pairs % len(self.known)], minlength=s.rows)


def training_rows(labelled: DataFrame, groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> pa.Table:
    """(label, found, swapped) of rows (text, label): distinct features, of the swapped text too if it differs."""
    swap = swapper(groups)
    kind = pa.list_(pa.int64())

    def of(texts: list[str]) -> list[np.ndarray]:
        out = []
        for s in text.slices(pa.array(texts, pa.large_string())):
            row, found = features(s)
            order = np.argsort(row, kind="stable")
            row, found = row[order], found[order]
            out += [np.unique(found[a:b]).view(np.int64) for a, b in zip(*(np.searchsorted(row, np.arange(s.rows) + i) for i in (0, 1)), strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [t or "" for t in part.column(0).to_pylist()]
                other = [swap(t) for t in texts]
                changed = iter(of([o for t, o in zip(texts, other, strict=True) if t != o]))
                swapped = [next(changed) if t != o else None for t, o in zip(texts, other, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(of(texts), kind), pa.array(swapped, kind)], names=["label", "found", "swapped"])

    return labelled.mapInArrow(run, "label int, found array<long>, swapped array<long>").toArrow()


def fit(rows: pa.Table, penalty: float = 1.0, ridge: float = 1e-3, rounds: int = 300, step: float = 0.05) -> Model:
    """Fit on ``training_rows``: log loss + ridge |w|^2 + penalty * mean squared score change by swaps.

    Without rows, or with one label only, the model is its smoothed base rate.
    """
    label = rows["label"].to_numpy().astype(float)
    n, positive = len(label), float(label.sum())
    base = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    if not 0 < positive < n:
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), base)
    lists = rows["found"].combine_chunks()
    row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    found = lists.flatten().to_numpy().view(np.uint64)
    known, place = np.unique(found, return_inverse=True)
    with_, in_positive = np.bincount(place), np.bincount(place, label[row])
    # likelihood ratio of each feature against the label
    share = positive / n
    expected = with_ * share
    ratio = in_positive * np.log(np.maximum(in_positive, 1e-9) / expected)
    negative = with_ - in_positive
    ratio += negative * np.log(np.maximum(negative, 1e-9) / (with_ * (1 - share)))
    ratio[with_ < MIN_COUNT] = 0
    best = np.sort(np.argsort(-ratio, kind="stable")[:MAX_FEATURES])
    best = best[ratio[best] > 2.0]
    slot = np.full(len(known), -1)
    slot[best] = np.arange(len(best))
    known = known[best]
    chosen = slot[place] >= 0
    row, col = row[chosen], slot[place][chosen]
    # counterfactual differences: features gained by the swap less features lost
    pairs_row, pairs_col, sign = [], [], []
    for k, (own, other) in enumerate(zip(rows["found"], rows["swapped"], strict=True)):
        if other.is_valid:
            a, b = (x.values.to_numpy().view(np.uint64) for x in (own, other))
            for values, s in ((np.setdiff1d(b, a), 1.0), (np.setdiff1d(a, b), -1.0)):
                at = np.searchsorted(known, values)
                at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == values)] if len(known) else at[:0]
                pairs_row.append(np.full(len(at), k))
                pairs_col.append(at)
                sign.append(np.full(len(at), s))
    p_row = np.concatenate([*pairs_row, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    p_col = np.concatenate([*pairs_col, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    p_sign = np.concatenate([*sign, np.zeros(0)])
    swaps = max(1, rows["swapped"].length() - rows["swapped"].null_count)

    m = len(known)
    w, b = np.zeros(m), base
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, rounds + 1):
        error = 1 / (1 + np.exp(-(b + np.bincount(row, w[col], minlength=n)))) - label
        gradient = np.bincount(col, error[row], minlength=m) / n + ridge * w
        if len(p_row):
            change = np.bincount(p_row, w[p_col] * p_sign, minlength=n)
            gradient += 2 * penalty / swaps * np.bincount(p_col, change[p_row] * p_sign, minlength=m)
        whole = np.append(gradient, error.mean())
        first = 0.9 * first + 0.1 * whole
        second = 0.999 * second + 0.001 * whole**2
        move = step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w -= move[:m]
        b -= move[m]
    return Model(known, w, float(b))


_SCORED = pa.schema([("score", pa.float64()), ("predicted", pa.int32())])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Each row with score and predicted, from the whole text alone.

    A null text counts as empty, and an empty one is scored too. Equal texts get equal scores, so
    repeated rows stay and agree; an empty table gives an empty result. Other columns are kept;
    those called score or predicted are replaced.
    """
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c not in _SCORED.names])
    own = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text.slices(batch.column(own.index(text_col))):
                p = 1 / (1 + np.exp(-np.clip(shared.value.logits(s), -500, 500)))
                part = batch.slice(s.first, s.rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*own, *_SCORED.names])

    return text.map_batches(docs, run, StructType([*docs.schema.fields, *from_arrow_schema(_SCORED).fields]))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of ids that training never reads; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING, groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Model:
    """Fit on labelled rows outside the held-out fifth, at most ``max_rows`` of them.

    Labels without an id or a value are left out; an id labelled more than once takes the greater
    label. The sample is the ids with the smallest hash, so it is the same on any layout.
    """
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # at most max_rows short rows
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")
    return fit(training_rows(rows, groups))
