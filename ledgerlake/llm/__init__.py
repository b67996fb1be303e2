"""Operators for building a training corpus: scoring, deduplication,
decontamination, licence scans, formatting, sharding, token files, packing.

Nothing outside this subpackage imports it; ``registry`` lists its queries.
"""
