"""Training-data operators: deduplication, extraction, classifiers, decontamination, mixing.

Nothing outside this subpackage imports it. Registered queries live in ``queries.py``,
their DuckDB statements in ``oracle.py``.
"""
