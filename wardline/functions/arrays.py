"""Small expression helpers over arrays, used by the sequence models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def literal_array(values: Sequence[float]) -> Column:
    """Array of doubles, handed to the plan as one piece of text."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def total(values: Sequence[Column]) -> Column:
    out = values[0]
    for v in values[1:]:
        out = out + v
    return out


def elements(values: Column, n: int) -> list[Column]:
    return [values[i] for i in range(n)]


def normalised(values: Column, n: int) -> Column:
    """The first ``n`` elements divided by their sum."""
    return let(total(elements(values, n)), lambda t: F.transform(values, lambda v: v / t))


def first_index_of_max(values: Column) -> Column:
    """Zero-based; ties go to the lower index."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def scan(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """States after each item. Arrays stay short, since every step copies the list so far."""
    empty = F.slice(F.array(start), 1, 0)
    state = F.struct(start.alias("now"), empty.alias("seen"))

    def merge(acc: Column, item: Column) -> Column:
        return let(
            step(acc["now"], item),
            lambda new: F.struct(new.alias("now"), F.concat(acc["seen"], F.array(new)).alias("seen")),
        )

    return F.aggregate(items, state, merge, lambda acc: acc["seen"])


def vector_add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def vector_subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def vector_scale(a: Column, by: Column | float) -> Column:
    return F.transform(a, lambda x: x * by)


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda t, v: t + v))
