"""Inside a task: the sums of one block of tiles after the other, with NumPy.

Spark has brought the tiles of a block together and sorted them by block; what is left
is arithmetic on arrays, in bounded memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_KEY = ["img_id", "bx", "by", "seg", "salt", "weight"]
# Pixels handed back to Spark at a time.
BATCH_BYTES = 32 << 20
# Pixels per tile that are summed over the block at a time, to stay in the processor's cache.
CACHE_PIXELS = 1024


def _tile_matrix(column: pa.Array, dtype) -> np.ndarray:
    """A column of tiles as a matrix, one row per tile."""
    lengths = (pc.binary_length(column) if dtype else pc.list_value_length(column)).to_numpy()
    if (lengths != lengths[0]).any():
        raise ValueError("tiles of one sum differ in length")
    if dtype:
        flat = np.frombuffer(b"".join(v.as_buffer() for v in column), dtype=dtype)
    else:
        flat = column.flatten()
        # a null pixel counts as 0
        flat = (pc.fill_null(flat, 0) if flat.null_count else flat).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if lengths[0] else np.zeros((len(column), 0), np.int64)


def _add_rows(total: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """total[at] += rows, where ``at`` may name a place more than once."""
    if np.bincount(at).max() > 1:
        order = np.argsort(at, kind="stable")
        at, first = np.unique(at[order], return_index=True)
        rows = np.add.reduceat(rows[order], first, axis=0, dtype=total.dtype)
    total[at] += rows


def _box_sum(source: np.ndarray, axis: int, n_out: int, start: int, reach: int) -> np.ndarray:
    """Sums along an axis: output i covers the sources ``start + i - reach .. start + i + reach``."""
    shape = list(source.shape)
    n_source, shape[axis] = shape[axis], n_out
    out = np.zeros(shape, dtype=source.dtype)
    before = (slice(None),) * axis
    for d in range(start - reach, start + reach + 1):
        first, last = max(0, -d), min(n_out, n_source - d)
        if first < last:
            out[*before, first:last] += source[*before, first + d:last + d]
    return out


class _BlockSums:
    """Sums of one block: its sources are added batch by batch, then its outputs read off.

    The sources reach ``source_halo`` tiles beyond the block, the outputs ``out_halo``.
    Memory is both in 8-byte pixels.
    """

    def __init__(self, key, grid, block, reach, source_halo, out_halo):
        self.img, bx, by, self.seg, _, self.weight = key
        self.grid, self.reach = grid, reach

        def span(b, halo, first, last):
            return max(b * block - halo, first), min((b + 1) * block + halo, last + 1)

        all_x, all_y = (0, grid.cols - 1), (0, grid.rows - 1)
        self.out_x, self.out_y = span(bx, out_halo, *all_x), span(by, out_halo, *all_y)
        self.src_x = span(bx, source_halo, *(grid.source_cols if reach else all_x))
        self.src_y = span(by, source_halo, *(grid.source_rows if reach else all_y))
        self.present = np.zeros((self.src_x[1] - self.src_x[0], self.src_y[1] - self.src_y[0]),
                                dtype=np.int32)
        self.total = None
        self.bounds = np.zeros(self.present.size)  # per place, what no sum of its pixels can exceed

    def add(self, x, y, rows):
        ix = x // self.grid.tile_w - self.src_x[0]
        iy = y // self.grid.tile_h - self.src_y[0]
        if self.total is None:
            kind = np.float64 if rows.dtype.kind == "f" else np.int64
            self.total = np.zeros((self.present.size, rows.shape[1]), dtype=kind)
        if rows.shape[1] != self.total.shape[1]:
            raise ValueError("tiles of one sum differ in length")
        if self.total.dtype == np.int64 and rows.size:
            size = np.maximum(rows.max(axis=1).astype(np.float64), -rows.min(axis=1).astype(np.float64))
            np.add.at(self.bounds, ix * self.present.shape[1] + iy, size)
            if self.bounds.max() * (2 * self.reach + 1) ** 2 * abs(self.weight) >= 2.0 ** 63:
                raise OverflowError(f"sums of image {self.img} may exceed 64 bits")
        _add_rows(self.total, ix * self.present.shape[1] + iy, rows)
        self.present[ix, iy] = 1

    def _neighbourhood(self, values):
        (x0, x1), (y0, y1) = self.out_x, self.out_y
        along_x = _box_sum(values, 0, x1 - x0, x0 - self.src_x[0], self.reach)
        return _box_sum(along_x, 1, y1 - y0, y0 - self.src_y[0], self.reach)

    def batches(self, dtype):
        total = self.total.reshape(*self.present.shape, -1)
        width = total.shape[2]
        xs, ys = np.nonzero(self._neighbourhood(self.present))
        out = np.empty((len(xs), width), dtype=total.dtype)
        for p in range(0, width, CACHE_PIXELS):
            out[:, p:p + CACHE_PIXELS] = self._neighbourhood(total[:, :, p:p + CACHE_PIXELS])[xs, ys]
        if self.weight != 1:
            out *= self.weight
        step = max(1, BATCH_BYTES // max(1, width * 8))
        for n in range(0, len(xs), step):
            i, j = xs[n:n + step], ys[n:n + step]
            yield pa.RecordBatch.from_pydict({
                "img_id": pa.array([self.img] * len(i)), "z": pa.array(np.full(len(i), self.grid.z)),
                "x": pa.array((self.out_x[0] + i) * self.grid.tile_w),
                "y": pa.array((self.out_y[0] + j) * self.grid.tile_h),
                "seg": pa.array(np.full(len(i), self.seg, dtype=np.int32)),
                "pixels": _pixel_column(out[n:n + step], dtype)})


def _key_runs(batch: pa.RecordBatch):
    """Cut a batch, sorted by block, where the block changes."""
    img = batch.column("img_id")
    change = pc.not_equal(img.slice(1), img.slice(0, len(img) - 1)).to_numpy(zero_copy_only=False)
    for name in BLOCK_KEY[1:]:
        change = change | (np.diff(batch.column(name).to_numpy()) != 0)
    cuts = [0, *(np.flatnonzero(change) + 1), len(img)]
    for first, end in zip(cuts, cuts[1:]):
        yield tuple(batch.column(name)[first].as_py() for name in BLOCK_KEY), slice(first, end)


def _merged(batches):
    """Join small batches up to about BATCH_BYTES."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size >= BATCH_BYTES:
            yield pa.concat_batches(waiting)
            waiting, size = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def _pixel_column(rows: np.ndarray, dtype):
    if dtype is not None:
        return pa.array([r.tobytes() for r in rows], type=pa.binary())
    n, width = rows.shape
    ends = np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def block_summer(grid, block, reach, source_halo, out_halo, limit=None, dtype=None):
    """Function for ``mapInArrow`` over tiles sorted by block.

    Adds every tile to the outputs within ``reach`` of it, pixels above ``limit`` as 0.
    ``dtype`` is the NumPy type of binary pixels, None for arrays.
    """
    def sums(batches):
        current, key = None, None
        for batch in batches:
            if batch.column("pixels").null_count:
                batch = batch.filter(batch.column("pixels").is_valid())
            if not batch.num_rows:
                continue
            xs, ys = batch.column("x").to_numpy(), batch.column("y").to_numpy()
            for found, at in _key_runs(batch):
                if found != key:
                    if current is not None:
                        yield from current.batches(dtype)
                    key = found
                    current = _BlockSums(key, grid, block, reach, source_halo, out_halo)
                tiles = batch.column("pixels").slice(at.start, at.stop - at.start)
                pixels = _tile_matrix(tiles, dtype)
                if limit is not None:
                    pixels = np.where(pixels > limit, pixels.dtype.type(0), pixels)
                current.add(xs[at], ys[at], pixels)
        if current is not None:
            yield from current.batches(dtype)

    def sum_blocks(batches):
        return _merged(sums(batches))

    return sum_blocks
