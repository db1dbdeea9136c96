"""Training-data operators: packing, near-duplicate search, token counts, vector
search, mixing, licence scans, WARC archives, language identification.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
