"""Operators of a training-data pipeline: filters, duplicates, token work, packing.

Nothing outside this subpackage imports it.
"""
