"""Training-data operators: dedup, tokenising, sharding, packing, scoring.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when the package is there.
"""
