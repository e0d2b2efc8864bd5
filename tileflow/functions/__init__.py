from .curve import morton
from .named import named_udf
from .pixels import (brightest_point, flatten_tile, int_div, quantise, reshape_tile, threshold,
                     tile_mean, tile_shape, zero_above)
from .tables import flat_map, flat_map_by_key, table_function

__all__ = ["brightest_point", "flat_map", "flat_map_by_key", "flatten_tile", "int_div", "morton", "named_udf", "quantise", "reshape_tile",
           "table_function", "threshold", "tile_mean", "tile_shape", "zero_above"]
