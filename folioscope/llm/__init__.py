"""Training-data operators: token counts, similarity joins, filters, packing and writers.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
