"""Training-data operators: one module per operator, queries in `queries.py`.

Nothing outside this package (and the pipeline file at the repository top)
imports it.
"""
