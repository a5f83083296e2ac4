"""Taxonomic-table analytics on Spark."""
