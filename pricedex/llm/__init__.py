"""Operators for large text corpora: dedup, extraction, archives, language, toxicity, decontamination, packing.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its queries when it is present.
"""
