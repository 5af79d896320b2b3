"""Implicit-feedback recommendation analytics on Spark DataFrames.

Interaction tables go in; splits, play counts, item rankings, factor models,
per-user top-N lists and metric tables come out.
"""

__version__ = "0.1.0"
