"""Operators for large training-data pipelines.  Nothing outside this folder,
``tests/llm`` and ``corpus_pipeline.py`` imports it."""
