"""Training-data operators: tokenising, search, deduplication, quality, PII and mixing."""
