"""Training-data operators: each module holds one operator, `queries.py` the
registered queries. Nothing outside this package imports it."""
