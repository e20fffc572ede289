"""Operators of a training-data pipeline over documents and pages.

Each module holds one operator with its general interface, the registered query
over a whole table, and the query's DuckDB statement where SQL can express it.
"""
