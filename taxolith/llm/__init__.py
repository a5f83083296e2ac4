"""Training-data operators: packing, deduplication, extraction, sharding, decontamination.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries when it
is present.
"""
