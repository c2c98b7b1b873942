"""Reductions of one hour's item means to a single reading.

A ladder is a list of item ids by preference, so the reduction does not depend on row
order. Null and zero means are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FAHRENHEIT_ID = 223761


def to_fahrenheit(value: Column) -> Column:
    """Readings below 50 are taken as Celsius, whatever id they were charted under."""
    return F.when(value < 50, value * 9.0 / 5.0 + 32).otherwise(value)


def _item_mean(item: int, itemid: str, value: str) -> str:
    """Mean of one item inside a group, null when absent or zero."""
    return f"nullif(avg({value}) FILTER (WHERE {itemid} = {item}), 0D)"


def ladder_value(ladder: Sequence[int], itemid: str = "itemid", value: str = "valuenum") -> Column:
    """Aggregate: mean of the most preferred item present in the group."""
    return F.expr("coalesce(" + ", ".join(_item_mean(i, itemid, value) for i in ladder) + ")")


def ladder_item(ladder: Sequence[int], itemid: str = "itemid", value: str = "valuenum") -> Column:
    """Aggregate: id behind :func:`ladder_value`."""
    arms = " ".join(f"WHEN {_item_mean(i, itemid, value)} IS NOT NULL THEN {i}" for i in ladder)
    return F.expr(f"CASE {arms} END")


def temperature_value(ladder: Sequence[int], itemid: str = "itemid", value: str = "valuenum") -> Column:
    return to_fahrenheit(ladder_value(ladder, itemid, value))


def temperature_item(ladder: Sequence[int], itemid: str = "itemid", value: str = "valuenum") -> Column:
    """Temperatures are always reported under the Fahrenheit id."""
    return F.when(ladder_value(ladder, itemid, value).isNotNull(), F.lit(FAHRENHEIT_ID))
