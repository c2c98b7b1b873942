"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

The windows of the test items are hashed in blocks of bounded size; each block is broadcast
and all training texts are scanned against it. A hash that is found is verified on the words
themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from wardline.llm import text
from wardline.llm.scratch import written

WINDOW = 10
#: Windows in one broadcast block: some 100 bytes each.
BLOCK_WINDOWS = 500_000
_SPANS = pa.list_(pa.list_(pa.int64()))
_FOUND = pa.schema([("n_words", pa.int64()), ("hit_spans", _SPANS), ("byte_spans", _SPANS), ("items", pa.list_(pa.string()))])


def normalised(texts: DataFrame, text_col: str) -> DataFrame:
    """Words of each text, A-Z lower-cased; null has none."""
    words = F.regexp_extract_all(
        F.translate(F.coalesce(text_col, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
        F.lit(0),
    )
    return texts.withColumn("_words", words)


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """(window, size, items): each distinct window of the items, words joined by blanks.

    An item of fewer words, but not none, is one window. A null item id counts as "null".
    """
    w = normalised(items, text_col).where(F.size("_words") > 0)
    size = F.least(F.size("_words"), F.lit(n))
    each = F.transform(F.sequence(F.lit(1), F.size("_words") - size + 1), lambda i: F.array_join(F.slice("_words", i, size), " "))
    return (
        w.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), size.alias("size"), F.explode(each).alias("window"))
        .groupBy("window", "size")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _hashes(words: list[bytes]) -> np.ndarray:
    joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    return text.Hasher(joined).ranges(ends - [len(w) for w in words], ends)


class _Block:
    """Windows of one block by size: sorted hashes, and what each hash stands for."""

    def __init__(self, rows: list):
        by_size: dict[int, dict[int, dict[bytes, list[str]]]] = {}
        for r in rows:
            words = r["window"].encode().split(b" ")
            _, h = text.grams(_hashes(words), np.zeros(len(words), dtype=np.int64), len(words))
            by_size.setdefault(r["size"], {}).setdefault(int(h[0]), {})[r["window"].encode()] = list(r["items"])
        self.sizes = {k: (np.array(sorted(v), dtype=np.uint64), v) for k, v in by_size.items()}

    def scan(self, s: text.Slice) -> tuple[text.Runs, dict[int, list[tuple[int, int, list[str]]]]]:
        """Words of the slice, and by row the (first word, words, items) of each verified hit."""
        low = text.Slice(s.first, text.LOWER[s.data], s.offsets)
        words = text.runs(low, text.ALNUM[low.data])
        hashes = text.Hasher(low.data).ranges(words.start, words.end)
        raw = low.data.tobytes()
        hits: dict[int, list[tuple[int, int, list[str]]]] = {}
        for size, (known, meaning) in self.sizes.items():
            at, gram = text.grams(hashes, words.row, size)
            place = np.minimum(np.searchsorted(known, gram), len(known) - 1)
            for i, g in zip(at[found := known[place] == gram].tolist(), gram[found].tolist(), strict=True):
                window = b" ".join(raw[a:b] for a, b in zip(words.start[i : i + size].tolist(), words.end[i : i + size].tolist(), strict=True))
                if window in meaning[g]:
                    hits.setdefault(int(words.row[i]), []).append((i, size, meaning[g][window]))
        return words, hits


def _scan(docs: DataFrame, text_col: str, rows: list) -> DataFrame:
    """``docs`` with n_words, hit_spans ([first, last) word numbers, merged), byte_spans, items."""
    block = docs.sparkSession.sparkContext.broadcast(rows)
    own = docs.columns
    at = own.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Block(block.value)
        for batch in batches:
            for s in text.slices(batch.column(at)):
                words, hits = known.scan(s)
                first = np.searchsorted(words.row, np.arange(s.rows))
                spans: list[list] = [[] for _ in range(s.rows)]
                places: list[list] = [[] for _ in range(s.rows)]
                items: list[list] = [[] for _ in range(s.rows)]
                for row, found in hits.items():
                    for i, size, _ in sorted(found, key=lambda x: x[0]):
                        if spans[row] and i <= spans[row][-1][1]:
                            spans[row][-1][1] = max(spans[row][-1][1], i + size)
                        else:
                            spans[row].append([i, i + size])
                    places[row] = [[int(words.start[a] - s.offsets[row]), int(words.end[b - 1] - s.offsets[row])] for a, b in spans[row]]
                    spans[row] = [[a - int(first[row]), b - int(first[row])] for a, b in spans[row]]
                    items[row] = sorted({x for *_, names in found for x in names})
                made = [text.per_row(s.rows, words.row), spans, places, items]
                part = batch.slice(s.first, s.rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(v, f.type) for v, f in zip(made, _FOUND, strict=True)]], names=[*own, *_FOUND.names]
                )

    return text.map_batches(docs, run, StructType([*docs.schema.fields, *from_arrow_schema(_FOUND).fields]))


def _merged(spans):
    """Overlapping or touching [a, b) pairs of a sorted list become one."""
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<array<long>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(F.element_at(done, -1), 2) >= s[0]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.array(F.element_at(done, -1)[0], F.greatest(F.element_at(F.element_at(done, -1), 2), s[1]))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def find(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Each row of ``docs`` with the words and items it shares with the benchmark.

    Result columns: n_words, hit_spans and byte_spans (merged [start, end) of hit words and of
    their bytes), items (ids as sorted strings). They replace columns of the same name. Null,
    empty and wordless texts have no words and no hits. Repeated rows are scanned each on its
    own. The benchmark is read in blocks of ``block_windows`` windows, one pass over ``docs``
    for each, so what is broadcast stays bounded; usually it is one block and nothing shuffles.
    """
    added = _FOUND.names
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c not in added])
    windows = item_windows(items, item_id, item_text, n)
    total = windows.count()
    blocks = max(1, -(-total // block_windows))
    if blocks == 1:
        return _scan(docs, text_col, windows.collect())
    dealt = windows.withColumn("_block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    before = "was_"
    while any(c.startswith(before) for c in docs.columns):
        before = f"_{before}"
    # the later blocks only add to what an earlier pass has found; a pass is written before the next block is fetched
    out = docs
    for b in range(blocks):
        found = _scan(out, text_col, dealt.where(F.col("_block") == b).drop("_block").collect())
        if b:
            found = found.select(
                *[found[f"`{c}`"] for c in docs.columns],
                "n_words",
                _merged(F.concat(f"{before}hit_spans", "hit_spans")).alias("hit_spans"),
                _merged(F.concat(f"{before}byte_spans", "byte_spans")).alias("byte_spans"),
                F.array_sort(F.array_union(f"{before}items", "items")).alias("items"),
            )
        if b == blocks - 1:
            return found
        out = written(found, "hits").withColumnsRenamed({c: f"{before}{c}" for c in added[1:]}).drop("n_words")
    return out


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return found.select(
        F.col(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", drop_share: float = 0.5) -> DataFrame:
    """Texts without their hit spans; a document hit in more than ``drop_share`` of its words goes.

    The columns of ``docs`` are returned as they came. Null texts stay null.
    """
    names = docs.columns
    found = find(docs.withColumnsRenamed({c: f"in_{c}" for c in names}), items, f"in_{text_col}")
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    body = F.col(f"in_{text_col}").cast("binary")
    cut = F.aggregate(
        "byte_spans",
        F.struct(F.lit(b"").alias("kept"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(F.concat(a["kept"], F.substring(body, (a["at"] + 1).cast("int"), (s[0] - a["at"]).cast("int"))).alias("kept"), s[1].alias("at")),
    )
    rest = F.substring(body, (cut["at"] + 1).cast("int"), F.length(body))
    new = F.when(F.size("byte_spans") == 0, F.col(f"in_{text_col}")).otherwise(F.concat(cut["kept"], rest).cast("string"))
    kept = found.where(n_hit <= F.lit(drop_share) * F.col("n_words"))
    return kept.select(*[(new if c == text_col else F.col(f"`in_{c}`")).alias(c) for c in names])


