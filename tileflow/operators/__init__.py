from .attach import assert_unique_tiles, attach_tiles, check_input_type, missing_tiles
from .combine import sum_tiles, to_long
from .compare import stored_diff, strategy_diff, tile_digest
from .expand import (backward_neighbours, build_items, expand_index_grid, expand_requests,
                     grid_neighbours, neighbours, source_fanout, source_ids)
from .group import group_tiles
from .halo import sum_neighbourhoods, sum_neighbourhoods_by_parts
from .keep import kept
from .wanted import wanted_filter
from .zones import read_zone_map, tiles_where, write_zone_map, zone_map

__all__ = ["assert_unique_tiles", "attach_tiles", "backward_neighbours", "build_items",
           "check_input_type", "expand_index_grid", "expand_requests", "grid_neighbours",
           "group_tiles", "kept", "missing_tiles", "neighbours", "read_zone_map", "source_fanout", "source_ids",
           "stored_diff", "strategy_diff", "sum_neighbourhoods", "sum_neighbourhoods_by_parts", "sum_tiles",
           "tile_digest", "tiles_where", "to_long", "wanted_filter", "write_zone_map", "zone_map"]
