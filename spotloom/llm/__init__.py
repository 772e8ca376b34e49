"""Operators for corpora and very large columns. Nothing else in the library imports this subpackage."""
