"""Operators for training-data pipelines: tokens, secrets, personal data, duplicates, quality."""
