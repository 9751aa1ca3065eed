"""Operators for preparing training data: scoring, de-duplication, packing, archives, search.

Every operator lives in a module of its own with a general interface; ``queries``
registers one query for each. Nothing outside this folder imports it.
"""
