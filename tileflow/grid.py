"""The tiling of an image: sizes, neighbourhood and the index arithmetic behind both."""

from __future__ import annotations

from dataclasses import dataclass, replace

CLIPS = ("origin", "image", "none")


@dataclass(frozen=True)
class TileGrid:
    """A regular grid of tiles laid over an image, in pixel coordinates.

    ``n_size`` is the reach of the square neighbourhood an output tile reads (1 is
    3x3, 2 is 5x5).  ``clip`` says which neighbours exist:

    * ``"origin"``: strictly positive offsets on both axes, open at the far edge;
    * ``"image"``: only tiles of the image itself;
    * ``"none"``: every neighbour.
    """

    # The default image and tile sizes.
    im_w: int = 60000
    im_h: int = 60000
    tile_w: int = 2000
    tile_h: int = 2000
    n_size: int = 1
    z: int = -1
    clip: str = "origin"

    def __post_init__(self):
        if min(self.im_w, self.im_h, self.tile_w, self.tile_h) < 1 or self.n_size < 0:
            raise ValueError("image and tile sizes must be positive, n_size not negative")
        if self.clip not in CLIPS:
            raise ValueError(f"clip must be one of {CLIPS}")

    @property
    def cols(self) -> int:
        """Output tiles along x; a remainder adds an edge tile."""
        return -(-self.im_w // self.tile_w)

    @property
    def rows(self) -> int:
        return -(-self.im_h // self.tile_h)

    @property
    def tile_factor(self) -> int:
        return self.im_w // self.tile_w

    @property
    def tiles_per_image(self) -> int:
        """Area ratio, rounded down: less than ``cols * rows`` if there is a remainder."""
        return (self.im_w * self.im_h) // (self.tile_w * self.tile_h)

    def downscale(self, factor: int) -> TileGrid:
        """The same tiling of an image ``factor`` times smaller on each axis."""
        im_w, im_h = self.im_w // factor, self.im_h // factor
        return replace(self, im_w=im_w, im_h=im_h,
                       tile_w=im_w // self.tile_factor, tile_h=im_h // self.tile_factor)

    def _sources(self, n_targets: int) -> tuple[int, int]:
        if self.clip == "image":
            return 0, n_targets - 1
        first = 1 if self.clip == "origin" else -self.n_size
        return first, n_targets - 1 + self.n_size

    @property
    def source_cols(self) -> tuple[int, int]:
        """First and last tile index along x that any output tile reads."""
        return self._sources(self.cols)

    @property
    def source_rows(self) -> tuple[int, int]:
        return self._sources(self.rows)

    @property
    def pairs_per_image(self) -> int:
        """Number of (output, input) pairs of one image."""
        def axis(n_targets, bounds):
            first, last = bounds
            return sum(max(0, min(i + self.n_size, last) - max(i - self.n_size, first) + 1)
                       for i in range(n_targets))

        return axis(self.cols, self.source_cols) * axis(self.rows, self.source_rows)

    @property
    def sources_per_image(self) -> int:
        (x0, x1), (y0, y1) = self.source_cols, self.source_rows
        return max(0, x1 - x0 + 1) * max(0, y1 - y0 + 1)
