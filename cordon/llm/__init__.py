"""Operators of a training-data pipeline over text tables.

One module per operator, each with its own general interface; ``queries.py`` registers the thin
``opN_*`` queries.  Nothing outside this package imports it.
"""
