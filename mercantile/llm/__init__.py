"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface and the thin ``opN_*`` query that applies it
to a whole test table; :mod:`.registry` lists the queries and their SQL twins.
"""
