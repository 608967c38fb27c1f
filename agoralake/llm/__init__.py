"""Operators for training corpora: near-duplicates, decontamination, mixing, quality, counts, sharding, extraction.

One module per operator; ``queries`` registers them. Nothing outside this folder imports it but the entry point and
``corpus_pipeline``.
"""
