"""Operators over document corpora: cleaning, deduplication, decontamination, sharding and packing."""
