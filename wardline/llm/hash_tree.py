"""Hierarchical weighted hash tree: region, rack and shard by weighted hash draws.

At each node every child draws -ln(u) / weight from a hash of the key and the child's name; the
least draw wins. A child whose weight grows can only win keys, one whose weight shrinks only
lose them, so keys move within subtrees whose weights change and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.numbering import number

#: Rows of a shard are numbered in this many buckets, so no task orders a whole shard.
SLOT_BUCKETS = 4096


@dataclass(frozen=True)
class Node:
    """A region, a rack, or a shard where ``shard`` is set."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def layout(shards: int, founding: int = 8, per_rack: int = 2, racks: int = 2) -> Node:
    """A tree of equal shards.

    The founding shards fill regions of ``racks`` racks. Each later shard is a region of its own,
    so that only the root sees a weight change: keys move into the new shard and nowhere else.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    leaf = [Node(f"shard {i}", shard=i) for i in range(shards)]
    first = leaf[: min(shards, founding)]
    rack = [Node(f"rack {i // per_rack}", tuple(first[i : i + per_rack])) for i in range(0, len(first), per_rack)]
    regions = [Node(f"region {i // racks}", tuple(rack[i : i + racks])) for i in range(0, len(rack), racks)]
    later = [Node(f"region of {s.name}", (Node(f"rack of {s.name}", (s,)),)) for s in leaf[founding:]]
    return Node("root", (*regions, *later))


def _draw(key: Column, child: Node) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.ln(u) / child.weight


def place(key: Column, node: Node) -> Column:
    """The shard of a key. Equal draws go to the child named first; null is a key like any other."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return place(key, node.children[0])
    won = F.least(*[F.struct(_draw(key, c).alias("draw"), F.lit(i).alias("i")) for i, c in enumerate(node.children)])["i"]
    return F.element_at(F.array(*[place(key, c) for c in node.children]), won + 1)


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row, by the law ``key``.

    Only the id and the number of shards decide the shard. A null id is one key; a null text
    counts as empty (size 1, crc32 0). Rows that repeat an id share its shard and have slots of
    their own. Any other column of ``docs`` is left out, so no name can clash.
    """
    key = docs[f"`{id_col}`"]
    body = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    placed = docs.select(
        key.alias(id_col),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(key, layout(shards)).alias("shard"),
        place(key, layout(shards + 1)).alias("grown_shard"),
    )
    # shards x buckets offsets: bounded, so they are broadcast
    numbered = number(placed, "shard", [id_col, "text_crc32", "size"], "slot", SLOT_BUCKETS, broadcast=True)
    return numbered.select(id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
