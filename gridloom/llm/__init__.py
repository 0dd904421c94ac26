"""Operators for training-data pipelines: extraction, quality, deduplication, decontamination, tokens, packing."""
