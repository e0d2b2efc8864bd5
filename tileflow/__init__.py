"""Image mosaics from very many tiles, as Spark DataFrames."""

import sys

from pyspark import cloudpickle

from .grid import TileGrid
from .plans import (fragment_pairs, fragment_pipeline, image_table, mosaic, mosaic_rectangle,
                    request_mosaic, with_tile_stats, write_mosaic)

# the few Python functions travel with the job, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["TileGrid", "fragment_pairs", "fragment_pipeline", "image_table", "mosaic",
           "mosaic_rectangle", "request_mosaic", "with_tile_stats", "write_mosaic"]
