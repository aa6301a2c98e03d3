"""Batch operators. All take and return DataFrames in the canonical layout."""
