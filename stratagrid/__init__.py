"""Terrain and structure-line analytics on Spark DataFrames."""
