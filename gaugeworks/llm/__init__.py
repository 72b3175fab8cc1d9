"""Corpus operators for language-model training data.

One module per operator; ``queries`` registers them over the provided
tables.  Nothing else in the library imports this subpackage.
"""
