"""Operators for training-data pipelines (tokens, packing, dedup, filters).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when the folder is present.
"""
