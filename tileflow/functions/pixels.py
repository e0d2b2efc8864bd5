"""Column functions over tile pixels.

A flat tile is ``array<number>`` in C order; an image is ``array<array<number>>``.
All of them are native expressions, so filters and column pruning pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: pixels above this are blanked by the reconstruction.
BRIGHT_LIMIT = 20


def int_div(a, b) -> Column:
    """Integer quotient of two columns (both must be non-negative or divide exactly)."""
    return F.call_function("div", a, b)


def zero_above(value, limit=BRIGHT_LIMIT) -> Column:
    """One pixel: 0 if above the limit (None: there is none), else unchanged (as NaN is)."""
    value = F.col(value) if isinstance(value, str) else value
    if limit is None:
        return value
    return F.when((value > limit) & ~F.isnan(value), F.lit(0)).otherwise(value)


def threshold(pixels, limit=BRIGHT_LIMIT) -> Column:
    """Partial reconstruction of a flat tile: every pixel above the limit becomes 0."""
    return F.transform(pixels, lambda v: zero_above(v, limit))


def quantise(pixels, type_name="int") -> Column:
    """Real pixels to whole ones, truncated toward zero."""
    return F.transform(pixels, lambda v: v.cast(type_name))


def flatten_tile(image) -> Column:
    return F.flatten(image)


def reshape_tile(pixels, height, width, channels=None) -> Column:
    """Flat tile to ``height`` rows of ``width`` pixels, each an array if there are ``channels``."""
    width = F.lit(width)
    rows = lambda data, n, size: F.transform(F.sequence(F.lit(0), F.lit(n) - 1),
                                             lambda r: F.slice(data, r * size + 1, size))
    if channels is None:
        return rows(pixels, height, width)
    return F.transform(rows(pixels, height, width * channels), lambda line: rows(line, width, F.lit(channels)))


def tile_shape(image, width=None, channels=None) -> Column:
    """``[height, width]`` of nested rows, or of a flat tile whose ``width`` is given; with
    ``channels`` (of a flat tile, or True for nested pixels) ``[height, width, channels]``."""
    if width is not None:
        last = [F.lit(width)] + ([] if channels is None else [F.lit(channels)])
        size = F.lit(width) * F.lit(channels or 1)
        return F.array(int_div(F.array_size(image), size).cast("int"), *last)
    row = F.get(image, F.lit(0))
    return F.array(F.array_size(image), F.array_size(row), *([F.array_size(F.get(row, F.lit(0)))] if channels else []))


def tile_mean(image) -> Column:
    """Mean of all pixels of an image; null for an image without pixels."""
    flat = F.flatten(image)
    total = F.aggregate(flat, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return F.try_divide(total, F.array_size(flat))


def brightest_point(image) -> Column:
    """(row, column) of the first largest pixel in C order."""
    flat = F.flatten(image)
    width = F.array_size(F.get(image, F.lit(0)))
    position = F.array_position(flat, F.array_max(flat)) - 1
    return F.struct(int_div(position, width).cast("int").alias("_1"),
                    (position % width).cast("int").alias("_2"))
