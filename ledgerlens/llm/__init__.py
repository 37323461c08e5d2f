"""Operators of a training-data pipeline: near duplicates, sharding, mixing, fingerprints, URL
rules, language identification, quality rules, packing, licence scans and WARC archives.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. Every operator takes
DataFrames and column names and selects only the columns it needs into its own names, so extra
columns, also with clashing names, never meet internal ones.
"""
