"""Training-data operators: sharding, tokenising, scans, quality, near-duplicates.

Nothing outside this subpackage (but for ``corpus_pipeline.py``) imports it.
"""
