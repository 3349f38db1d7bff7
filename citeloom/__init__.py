"""citeloom: citation discovery and text-collection processing on Spark DataFrames."""
