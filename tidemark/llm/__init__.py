"""Training-data pipeline operators (one module per operator).

Nothing outside this folder, ``corpus_pipeline.py`` and the entry point's guard
imports it. ``queries.py`` holds the registered queries, ``oracle.py`` their SQL.
"""
