"""Operators of a training-data pipeline (deduplication, quality, extraction,
decontamination, tokenization, archives, URL rules). Nothing outside this
subpackage, its tests and ``corpus_pipeline.py`` imports it."""
