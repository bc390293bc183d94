"""Training-data operators: corpus cleaning, deduplication, tokenization and formatting.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
