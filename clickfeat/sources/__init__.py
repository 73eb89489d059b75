"""Readers: typed DataFrames out of files and out of the driver's test tables."""
