"""Sparse raster-tile pyramids on Spark: tiles, grids, rasters and their upkeep as DataFrame operators."""

import sys

from pyspark import cloudpickle

# Workers need no copy of the package: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
