"""Operators for training-data pipelines: dedup, language, tokens, packing, search and scoring as Spark jobs."""
