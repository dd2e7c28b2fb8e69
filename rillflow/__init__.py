"""Spark jobs for large-sample hydrology: flow series, forcing, rasters, river networks and attributes."""
