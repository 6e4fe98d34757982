"""Training-data operators: dedup, decontamination, encoding, filtering, extraction.

Nothing outside this subpackage imports it.
"""
