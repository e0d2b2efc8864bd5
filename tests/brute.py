"""Plain Python answers for small inputs, written without the library."""

import numpy as np


def targets(img, im_w, im_h, tile_w, tile_h):
    return [(img, x, y) for x in range(0, im_w, tile_w) for y in range(0, im_h, tile_h)]


def exists(sx, sy, grid):
    if grid.clip == "origin":
        return sx > 0 and sy > 0
    if grid.clip == "image":
        return 0 <= sx < grid.im_w and 0 <= sy < grid.im_h
    return True


def pairs(img, grid):
    found, n = [], grid.n_size
    for _, x, y in targets(img, grid.im_w, grid.im_h, grid.tile_w, grid.tile_h):
        for i in range(-n, n + 1):
            for j in range(-n, n + 1):
                sx, sy = x + i * grid.tile_w, y + j * grid.tile_h
                if exists(sx, sy, grid):
                    found.append((img, x, y, sx, sy))
    return found


def mosaic(request_ids, tiles, grid, limit=20):
    """tiles: {(img, x, y): list of pixels} -> {(img, x, y): list of sums}"""
    sums = {}
    for img in request_ids:
        for _, x, y, sx, sy in pairs(img, grid):
            if (img, sx, sy) in tiles:
                v = np.array(tiles[img, sx, sy], dtype=np.int64)
                v[v > limit] = 0
                sums[img, x, y] = sums.get((img, x, y), 0) + v
    return {k: [int(p) for p in v] for k, v in sums.items()}
