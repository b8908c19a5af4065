"""Operators for large text corpora: token files, classifiers, search, redaction, sharding, decontamination, near copies."""
