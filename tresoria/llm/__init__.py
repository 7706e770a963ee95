"""Training-data operators: scanning, extraction, packing, scoring and dedup.

Nothing outside this subpackage imports it; its registered queries are in
``queries.py``.
"""
