"""Operators of a training-data pipeline over documents, pages and embeddings.

Each module holds one operator with its own general interface. ``queries`` applies them to the
driver's tables. Nothing outside this subpackage imports it (``corpus_pipeline.py`` and the
guarded registration in ``__spark_entry__.py`` aside).
"""
