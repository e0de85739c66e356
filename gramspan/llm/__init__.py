"""Operators for training data: deduplication, quality, decontamination, mixing, archives."""
