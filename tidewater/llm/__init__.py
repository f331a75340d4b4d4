"""Training-data operators: dedup, classifiers, search, mixing, token output.

Nothing else in the package imports this subpackage; its registered queries
and their SQL live in :mod:`tidewater.llm.queries`.
"""
