"""Training-data pipeline operators: packing, licence scans, personal data, language
identification, HTML extraction, line and document deduplication, quality rules,
archive fixity and benchmark decontamination.

Nothing outside this subpackage (but for ``corpus_pipeline.py``) imports it.
"""
