"""Readers: text formats to long DataFrames."""
