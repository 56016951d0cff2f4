"""Operators for preparing text and vector corpora: near-duplicates, scans, scoring, packing, extraction.

One module per operator; ``queries`` applies each to its whole table. Nothing outside this folder imports it.
"""
