"""Several order columns as one number, so that "the first row" is a plain
``min`` that Spark aggregates by hash.

``min`` and ``min_by`` over a struct have no fixed-width buffer, so Spark
sorts all rows by the grouping key first.  The order columns' bounds (one
narrow aggregate over them) give each column a radix; the mixed-radix number
has the order of the columns, missing last, and can be taken apart again.
Times that are all whole days, or seconds, are counted in those.  The number
is a long if it fits, else a decimal of up to 31 digits; columns of other
types, or with wider bounds, cannot be packed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDE = "decimal(31,0)"
_UNITS = (86_400_000_000, 1_000_000)  # microseconds of a day, a second


def _as_long(c: Column, kind: T.DataType) -> Column | None:
    """A long in the order of the column, if there is one."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    return None


def _from_long(n: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return n.cast("int").cast("boolean")
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(n.cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(n)
    return n.cast(kind)


@dataclass(frozen=True)
class PackedOrder:
    """Order columns, their types, and for each its lowest value, radix
    (values in its bounds, and one for a missing value) and unit (a divisor
    of all its values)."""
    names: tuple[str, ...]
    kinds: tuple[T.DataType, ...]
    lows: tuple[int, ...]
    radixes: tuple[int, ...]
    units: tuple[int, ...]

    @property
    def kind(self) -> str:
        return "long" if prod(self.radixes) < 1 << 63 else _WIDE

    def key(self) -> Column:
        """The packed number of a row: columns in longs as far as they fit,
        then those in one number."""
        groups: list[tuple[Column, int]] = []
        for name, kind, low, radix, unit in zip(self.names, self.kinds, self.lows, self.radixes, self.units):
            above = _as_long(F.col(f"`{name}`"), kind) - F.lit(low).cast("long")
            if unit > 1:
                above = F.call_function("div", above, F.lit(unit).cast("long"))
            digit = F.coalesce(above, F.lit(radix - 1).cast("long"))
            if groups and groups[-1][1] * radix < 1 << 63:
                before, size = groups[-1]
                groups[-1] = (before * F.lit(radix).cast("long") + digit, size * radix)
            else:
                groups.append((digit, radix))
        out = groups[0][0].cast(self.kind)
        for digits, size in groups[1:]:
            out = (out * F.lit(size).cast("decimal(19,0)") + digits).cast(self.kind)
        return out

    def column(self, packed: Column, name: str) -> Column:
        """An order column's value in a packed number."""
        for at in range(len(self.names) - 1, -1, -1):
            radix = F.lit(self.radixes[at]).cast("long")
            digit = F.pmod(packed, radix).cast("long")
            if self.names[at] == name:
                value = F.when(digit < self.radixes[at] - 1,
                               digit * F.lit(self.units[at]).cast("long") + F.lit(self.lows[at]).cast("long"))
                return _from_long(value, self.kinds[at])
            packed = F.call_function("div", packed, radix) if self.kind == "long" else ((packed - digit) / radix).cast(_WIDE)
        raise KeyError(name)


def pack_order(rows: DataFrame, order: list[str], found_in: Sequence[DataFrame] = ()) -> PackedOrder | None:
    """How to pack the order columns of these rows; None if a column has no
    such number or the bounds are too wide.  Runs one aggregate over them, or
    one over each frame of ``found_in``: frames with columns of the same name
    and type that hold every value of ``rows`` (the tables that a join makes
    ``rows`` from), so that the join is not run for its bounds."""
    types = {f.name: f.dataType for f in rows.select(*[F.col(f"`{c}`") for c in order]).schema}
    kinds = tuple(types[c] for c in order)
    if any(_as_long(F.col(f"`{c}`"), k) is None for c, k in zip(order, kinds)):
        return None
    bounds: dict[str, tuple[int, int, int]] = {}
    for frame in (*found_in, rows):
        mine = [c for c in order if c in frame.columns and c not in bounds]
        if not mine:
            continue
        wanted = []
        for c in mine:
            n = _as_long(F.col(f"`{c}`"), types[c])
            uneven = [F.max(F.pmod(n, F.lit(u).cast("long"))) if isinstance(types[c], T.TimestampType) else F.lit(1) for u in _UNITS]
            wanted.append(F.struct(F.min(n), F.max(n), *uneven))
        for c, (low, high, *uneven) in zip(mine, frame.agg(*wanted).first()):
            unit = next((u for u, rest in zip(_UNITS, uneven) if rest == 0), 1)
            bounds[c] = (low or 0, high or 0, unit)
    lows, highs, units = zip(*(bounds[c] for c in order))
    radixes = tuple((high - low) // unit + 2 for low, high, unit in zip(lows, highs, units))
    if prod(radixes) >= 10 ** 31 or max(h - low for low, h in zip(lows, highs)) >= (1 << 62) - 2:
        return None
    return PackedOrder(tuple(order), kinds, lows, radixes, units)
