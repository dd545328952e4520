"""Column functions and raster kernels."""
