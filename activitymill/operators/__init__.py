"""Builders that take DataFrames and return DataFrames."""
