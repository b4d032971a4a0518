"""Operators for preparing language-model training data.

One module per operator, plus ``queries`` (the registered ``opN_`` queries)
and ``oracle`` (their DuckDB SQL where SQL can express them).  Nothing else in
the library imports this subpackage.
"""
