"""Operators of a training-data pipeline (corpus mixing, search, dedup, tokens).

Each module holds one operator with its general interface and the thin
registered query that reports the digest columns of its contract. Nothing
outside this subpackage imports it; ``registry`` lists the queries.
"""
