"""Operators for training-data pipelines: near-duplicates, language models, contamination and the like.

Nothing else in the library imports this subpackage.
"""
