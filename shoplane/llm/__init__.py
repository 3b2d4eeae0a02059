"""Operators for training-data pipelines over the document, page and label tables.

One module per operator; ``queries.py`` applies each of them to its whole table. Nothing else in the
library imports this package, so it can be removed as a whole.
"""
