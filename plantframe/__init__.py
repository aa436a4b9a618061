"""Industrial data on Spark: resource tables, downsampling, merges, trees, graphs and incremental sync."""

from .errors import PlantError
from .session import configure, cut_lineage, scratch_dir

__all__ = ["PlantError", "configure", "cut_lineage", "scratch_dir"]
