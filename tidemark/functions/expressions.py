"""Column expressions shared by the operators; all native, so code generation stays unbroken."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str, alias: str | None = None) -> Column:
    """Column by its exact name, whatever characters (``__$operation``, dots) it holds."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{alias}.{quoted}" if alias else quoted)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is unknown)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def lsn_hex(position: Column) -> Column:
    """Binary log position to ``0x`` text. Equal widths keep the order."""
    return F.concat(F.lit("0x"), F.hex(position))


def lsn_bytes(text: Column) -> Column:
    """``0x`` text back to the binary log position."""
    return F.unhex(F.substring(text, 3, 2**31 - 1))


def watermark_text(value: Column) -> Column:
    """Watermark as text without loss: microseconds stay, NULL stays NULL."""
    return value.cast("string")


def person_name(first: Column, middle: Column, last: Column) -> Column:
    """Full name; a missing middle name is left out, any other missing part makes it NULL."""
    space = F.lit(" ")
    return F.when(middle.isNull(), F.concat(first, space, last)).otherwise(
        F.concat(first, space, middle, space, last)
    )


def case_of(value: Column, names: Mapping[object, str], otherwise: str) -> Column:
    """Simple CASE: the name listed for the value, else the default."""
    branches = reduce(lambda chain, kv: chain.when(value == F.lit(kv[0]), F.lit(kv[1])), names.items(), F)
    return branches.otherwise(F.lit(otherwise))


def same_key(keys: Iterable[str], left: str, right: str) -> Column:
    """Composite-key equality between two aliased frames."""
    return reduce(and_, [column(k, left) == column(k, right) for k in keys])


def null_safe_match(keys: Iterable[str], left: str, right: str) -> Column:
    """Like ``same_key`` but NULL matches NULL, as it does in grouping."""
    return reduce(and_, [column(k, left).eqNullSafe(column(k, right)) for k in keys])
