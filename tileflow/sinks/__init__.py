from .blocks import mosaic_of_blocks, write_block_table
from .images import image_manifest, read_images, read_rectangle, write_images

__all__ = ["image_manifest", "mosaic_of_blocks", "read_images", "read_rectangle", "write_block_table",
           "write_images"]
