"""Operators for large-scale training-data preparation.

One module per operator, plus ``common`` (shared helpers) and ``queries``
(the registered queries and their DuckDB oracles). Nothing else in the
library imports this subpackage.
"""
