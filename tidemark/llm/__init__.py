"""Training-data operators: one module per operator, queries in ``queries.py``, SQL in ``sql.py``.

Nothing else in the package imports this subpackage.
"""
