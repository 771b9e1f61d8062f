"""Operators for preparing training corpora: ten text operators, their
registered queries and SQL.  Nothing outside this folder (and
``corpus_pipeline.py`` / ``tests/llm``) imports it."""
