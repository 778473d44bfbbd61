"""Operators on text corpora: packing, deduplication, classifiers, decontamination, WARC."""
