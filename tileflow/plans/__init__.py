from .fragments import fragment_pairs, fragment_pipeline, request_mosaic
from .images import image_table, with_tile_stats
from .mosaic import mosaic, mosaic_rectangle
from .outputs import write_mosaic

__all__ = ["fragment_pairs", "fragment_pipeline", "image_table", "mosaic", "mosaic_rectangle", "request_mosaic",
           "with_tile_stats", "write_mosaic"]
