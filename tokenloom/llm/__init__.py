"""Operators for preparing training corpora, one module per operator.

Nothing else in the library imports this subpackage.  ``registry`` lists the
registered queries and their DuckDB twins.
"""
