from .keys import key_table, tile_key
from .requests import request_list, request_weights, requests
from .tile_source import TileFiles, read_tile_source, write_tile_files
from .tiles import (TILE_KEY, read_tile_files, read_tiles, synthetic_reader, synthetic_tiles,
                    tiles_from_vectors)

__all__ = ["TILE_KEY", "TileFiles", "key_table", "read_tile_files", "read_tile_source", "read_tiles", "request_list",
           "request_weights", "requests", "synthetic_reader", "synthetic_tiles", "tile_key",
           "tiles_from_vectors", "write_tile_files"]
