"""Operators of a training-data pipeline: filters, scans, near-duplicates, search, mixing, packing.

Nothing else in the package imports this one. Each module holds one operator with its general interface;
:mod:`panelspark.llm.queries` registers one query per operator.
"""
