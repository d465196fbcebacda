"""Operators of a training-data pipeline (tokens, duplicates, language models, extraction).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it can be imported.
"""
