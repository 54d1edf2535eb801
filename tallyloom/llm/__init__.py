"""Operators for preparing training text: fingerprints, language, secrets, quality, dedup, mixing, tokens.

Nothing else in the library imports this package.  Every operator takes a
DataFrame of documents and returns a DataFrame; ``queries`` registers one query
per operator.
"""
