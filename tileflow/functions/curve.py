"""Places along a space-filling curve: near on the curve is near in both directions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The masks that spread the bits of a 31-bit number to every second place.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
           (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(value: Column) -> Column:
    value = value.cast("bigint")
    for bits, mask in _SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, bits)).bitwiseAND(F.lit(mask))
    return value


def morton(x, y) -> Column:
    """The Morton number of two indexes from 0 to 2**31 - 1: their bits, interleaved, x first."""
    x, y = (F.col(v) if isinstance(v, str) else v for v in (x, y))
    return F.shiftleft(_spread(x), 1).bitwiseOR(_spread(y))
