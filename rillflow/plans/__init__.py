"""Queries: operators applied to the driver's tables."""
