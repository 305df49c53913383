"""Analytic operators: DataFrames in, DataFrame out."""
