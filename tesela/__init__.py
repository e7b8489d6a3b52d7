"""Tesela: DataFrame operators for cleaning, profiling and comparing keyed tables."""

__version__ = "0.1.0"
