"""Gridded-cube analytics on Spark."""
