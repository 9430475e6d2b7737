"""Operators of a training-data pipeline over documents and web pages.

Each module holds one operator with its own general interface; ``queries``
binds them to the supplied tables under the names ``op1_…`` to ``op13_…``.
Nothing else in the library imports this package.
"""
