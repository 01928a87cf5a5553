"""Operators that prepare training data for language models: scoring, filtering, deduplication, tokenising."""
