"""Operators of a training-data pipeline, each a Spark job over the ``documents`` table.

One module per operator; ``queries`` holds the thin registered queries and ``oracles``
their DuckDB text. Nothing else in the library imports this subpackage.
"""
