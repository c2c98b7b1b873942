"""Quality rules by zstandard compression bands.

Repetitive text compresses too well, random text hardly at all. Both whole documents and
fixed chunks are compressed; the limits depend on the length, since short texts compress
less. A chunk rule catches a document that is junk in part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from wardline.llm import text


@dataclass(frozen=True)
class Band:
    """Limits of compressed / raw bytes for texts of at least ``min_bytes``."""

    min_bytes: int
    low: float
    high: float


#: By rising length. The upper limits lie above ordinary prose (largest ratio of sf0.1 0.69, 0.60, 0.53,
#: 0.48 and 0.42 from 0.5, 1, 2, 4 and 32 KB; of licences and other plain English 0.78, 0.70, 0.63,
#: 0.56 and 0.42) and below random letters and digits (0.81, 0.76, 0.74, 0.73 and 0.72).
WHOLE_BANDS = (
    Band(0, 0.0, math.inf), Band(256, 0.20, 0.85), Band(384, 0.20, 0.80), Band(512, 0.20, 0.76), Band(768, 0.20, 0.72), Band(1024, 0.15, 0.70),
    Band(2048, 0.15, 0.64), Band(4096, 0.12, 0.58), Band(8192, 0.12, 0.56), Band(32768, 0.10, 0.50),
)
CHUNK_BANDS = (Band(0, 0.0, math.inf), Band(1024, 0.12, 0.70), Band(2048, 0.12, 0.64), Band(4096, 0.10, 0.58))
CHUNK_BYTES = 4096
MAX_BAD_CHUNKS = 0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _outside(bands: tuple[Band, ...], raw: int, packed: int) -> bool:
    band = next(b for b in reversed(bands) if raw >= b.min_bytes)
    return not band.low <= packed / max(raw, 1) <= band.high


def _counts(s: text.Slice) -> dict[str, np.ndarray]:
    n = s.rows
    inside = text.SPACED[s.data]
    words = text.runs(s, inside)
    row_of = np.repeat(np.arange(n), np.diff(s.offsets))
    hasher = text.Hasher(s.data)
    lines = text.lines(s)
    filled = np.unique(np.searchsorted(lines.end, words.start, side="right"))
    key = text.mix(hasher.ranges(lines.start[filled], lines.end[filled]) + lines.row[filled].astype(np.uint64))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), dtype=bool)
    again[first] = False

    at, gram = text.grams(hasher.ranges(words.start, words.end), words.row, 3)
    gram = text.mix(gram + words.row[at].astype(np.uint64))
    _, back, times = np.unique(gram, return_inverse=True, return_counts=True)
    repeated = at[times[back] > 1] if len(at) else at
    covered = np.zeros(len(words.row) + 3, dtype=bool)
    for i in range(3):
        covered[repeated + i] = True
    point = inside & ((s.data & 0xC0) != 0x80)
    return {
        "n_words": text.per_row(n, words.row),
        "word_chars": text.per_row(n, row_of[point]),
        "n_symbols": text.per_row(n, row_of[_SYMBOLS[s.data]]),
        "n_dup_lines": text.per_row(n, lines.row[filled][again]),
        "n_repeat_words": text.per_row(n, words.row[covered[: len(words.row)]]),
    }


def _verdicts(s: text.Slice, level: int) -> dict[str, list]:
    packer = zstandard.ZstdCompressor(level=level)
    view = memoryview(np.ascontiguousarray(s.data))
    out: dict[str, list] = {"whole_ratio": [], "n_chunks": [], "n_bad_chunks": [], "in_band": []}
    for a, b in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist(), strict=True):
        packed = len(packer.compress(view[a:b]))
        bad, chunks = 0, 0
        if b - a > CHUNK_BYTES:
            for c in range(a, b, CHUNK_BYTES):
                d = min(c + CHUNK_BYTES, b)
                bad += _outside(CHUNK_BANDS, d - c, len(packer.compress(view[c:d])))
                chunks += 1
        out["whole_ratio"].append(packed / max(b - a, 1))
        out["n_chunks"].append(chunks)
        out["n_bad_chunks"].append(bad)
        out["in_band"].append(not _outside(WHOLE_BANDS, b - a, packed) and bad <= MAX_BAD_CHUNKS * chunks)
    return out


_ADDED = pa.schema(
    [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("whole_ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
)


def assess(docs: DataFrame, text_col: str = "text", level: int = 3) -> DataFrame:
    """Each row with its counts and verdict; row by row, so there is no shuffle and no key.

    Columns of ``docs`` that bear a result's name are replaced. A null, empty or wordless text
    has counts of 0, fails the base rules and is not kept; so repeated rows get equal results
    and an empty table gives an empty result. Whole texts are counted and compressed.
    """
    own = [c for c in docs.columns if c not in _ADDED.names or c == text_col]
    source = docs.select(*[docs[f"`{c}`"] for c in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text.slices(batch.column(own.index(text_col))):
                made = _counts(s) | _verdicts(s, level)
                failed = (made["n_words"] < MIN_WORDS) | (100 * made["n_repeat_words"] > MAX_REPEAT_PERCENT * made["n_words"])
                made |= {"base_failed": failed, "kept": ~failed & np.array(made.pop("in_band"), dtype=bool)}
                part = batch.slice(s.first, s.rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(made[f.name], f.type) for f in _ADDED]], names=[*own, *_ADDED.names]
                )

    return text.map_batches(source, run, StructType([*source.schema.fields, *from_arrow_schema(_ADDED).fields]))


def keep(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with the columns they came with.

    Null and empty texts fail. Repeated rows are judged alike and all stay or go; rows without an
    id are judged like others. An empty table stays empty, and no column name can clash.
    """
    names = docs.columns
    kept = assess(docs.withColumnsRenamed({c: f"in_{c}" for c in names}), f"in_{text_col}").where("kept")
    return kept.select(*[kept[f"`in_{c}`"].alias(c) for c in names])
