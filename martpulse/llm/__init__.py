"""Operators for training-data pipelines (filtering, deduplication, decontamination, tokenising).

Nothing outside this package (and ``corpus_pipeline.py``) imports it; ``queries.py`` registers one
``opN_<name>`` query per operator.
"""
