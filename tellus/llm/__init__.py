"""Operators of a training-data pipeline: fingerprints, packing, nearest
neighbours, repeated-substring removal, toxicity, near duplicates, language
ID, licence scans, chat formatting and byte-level BPE.

Each module holds one operator with its own general interface;
``queries.py`` holds the thin registered queries. Nothing outside this
subpackage imports it.
"""
