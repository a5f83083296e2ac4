"""Streams of files: early release of whole groups, running counts, duplicates."""
