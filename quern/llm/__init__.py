"""Operators for training-data pipelines: quality, archives, tokens, mixing, PII, near copies."""
