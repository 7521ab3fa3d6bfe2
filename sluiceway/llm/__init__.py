"""Operators for preparing training data: cleaning, deduplication, classification, mixing and sharding of a corpus."""
