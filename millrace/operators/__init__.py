"""Operators over message DataFrames and tables."""
