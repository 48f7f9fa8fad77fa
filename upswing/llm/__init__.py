"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Each module holds one operator with its own general interface; ``queries``
binds them to the tables of a data folder.
"""
