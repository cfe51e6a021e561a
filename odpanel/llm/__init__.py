"""Operators of a training-data pipeline: quality rules, sharding, benchmark
decontamination, language ID, license scans, source mixing, near-duplicates,
token output, substring dedup and WARC archives.

Nothing else in the library imports this package.
"""
