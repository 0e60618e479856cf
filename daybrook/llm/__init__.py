"""Training-data operators: scans, deduplication, tokenization, packing, nearest neighbours.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which counts as part of it) imports it.
"""
