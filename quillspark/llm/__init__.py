"""Operators of a training-data pipeline: dedup, scoring, packing, filtering, archives, shards.

Nothing else in the library imports this package; ``__spark_entry__`` adds its queries when
it can be imported.
"""
