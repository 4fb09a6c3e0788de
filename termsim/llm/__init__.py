"""Training-data operators (numbered operators), each in a module of its own.

Nothing outside this package imports it; ``queries.py`` registers the queries.
"""
