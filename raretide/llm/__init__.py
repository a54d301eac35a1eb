"""Operators for preparing training text, one module per operator.

Each module holds a general DataFrame-in/DataFrame-out operator and the thin
query ``opN_...`` that applies it to its table.  ``registry`` collects the
queries and their SQL.  Nothing outside this package imports it, apart from
the guarded import in ``__spark_entry__``.
"""
