"""Operators that prepare text and vectors for training, each by one method, on whole tables.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
