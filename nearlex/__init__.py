"""Nearest-neighbour text analytics on Spark DataFrames."""
