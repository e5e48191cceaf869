"""Operators of a training-data pipeline: PII spans, WARC archives, benchmark
decontamination, suffix-array dedup, quality and toxicity models, main-text
extraction, SimHash and line dedup, sequence packing.

Nothing outside this folder imports it; ``queries.py`` registers one query per
operator and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
