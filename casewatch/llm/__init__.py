"""Training-data operators: quality, PII, secrets, licences, mixing, dedup, packing, token counts.

Self-contained: nothing else in the library imports this package.
"""
