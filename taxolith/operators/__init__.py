"""Operators on long tables: abundance, lineage, evidence, accounting, reads, cells, cohorts."""
