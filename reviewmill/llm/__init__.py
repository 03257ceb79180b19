"""Training-data operators: filters, extraction, deduplication, search and tokens."""
