"""Operators over DataFrames: staging, models, tables, checks, regression."""
