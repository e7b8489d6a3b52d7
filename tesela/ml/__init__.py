"""Clustering, tree models and their metrics on DataFrames."""
