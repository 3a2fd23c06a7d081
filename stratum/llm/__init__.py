"""Training-data operators: dedup, mixing, filters, search, archives.

Every module here is self-contained: the operator is a plain function on
DataFrames, and the registered ``opN_*`` query is a thin wrapper in
``queries.py``.  Nothing outside this package imports it.
"""
