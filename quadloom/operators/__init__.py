"""DataFrame operators on tiles, grids and rasters."""
