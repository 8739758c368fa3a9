"""Operators of a training-data pipeline: deduplication, archives, filters, sharding and
tokenisation over a ``documents`` table. Nothing else in the package imports this folder."""
