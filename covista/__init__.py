"""Recommendation analytics on Spark DataFrames.

Layers: ``sources`` (readers, writers, stored models), ``functions`` (column
expressions), ``plans`` (skew-safe joins, ranking, vector search) and
``operators`` (the recommenders and their evaluation).
"""
