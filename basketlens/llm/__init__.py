"""Operators for text corpora: counting, cleaning, deduplication, classification, tokenizing."""
