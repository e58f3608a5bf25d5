"""Operators for preparing text corpora: packing, language, fingerprints, quality, deduplication, archives, sharding."""
