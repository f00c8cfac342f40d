"""One stated type for a column whose parts were inferred with different types.

Types widen upwards, never losing a value:

    int < bigint < decimal < double < string,   date < timestamp < string,   boolean < string

``None`` (a part where the column has no value) gives way to any type. Two types with no common
type but text become text; as parts are then read once more with the stated types,
a cell keeps the text that it has in the file, leading zeros too.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import types as T

_NUMBERS = (T.IntegerType, T.LongType, T.DecimalType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampType)
#: Digits that a bigint may have.
_LONG_DIGITS = 20


def _digits(t: T.DataType) -> tuple[int, int]:
    """Digits before and after the point that a whole or decimal number may have."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (10 if isinstance(t, T.IntegerType) else _LONG_DIGITS), 0


def wider(a: T.DataType | None, b: T.DataType | None) -> T.DataType | None:
    """The least type that holds the values of both."""
    if a is None or b is None or a == b:
        return b if a is None else a
    for ladder in (_NUMBERS, _TIMES):
        if isinstance(a, ladder) and isinstance(b, ladder):
            top = max((a, b), key=lambda t: ladder.index(type(t)))
            if not isinstance(top, T.DecimalType):
                return top
            whole, parts = (max(x) for x in zip(_digits(a), _digits(b), strict=True))
            return T.DecimalType(whole + parts, parts) if whole + parts <= 38 else T.DoubleType()
    return T.StringType()


def stated(found: Iterable[dict[str, T.DataType | None]]) -> dict[str, T.DataType | None]:
    """Of each column's types in several parts the one that holds all."""
    out: dict[str, T.DataType | None] = {}
    for types in found:
        for name, t in types.items():
            out[name] = reduce(wider, (out.get(name), t))
    return out
