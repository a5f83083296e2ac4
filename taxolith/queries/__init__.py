"""Registered queries on the given tables, with DuckDB SQL for each that SQL can express."""
