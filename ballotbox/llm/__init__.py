"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; the queries are registered
by ``__spark_entry__.py`` only when it can be imported.
"""
