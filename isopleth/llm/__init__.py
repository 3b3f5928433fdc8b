"""Operators for preparing large text corpora.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` uses it.
"""
