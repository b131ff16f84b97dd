"""Training-data operators (URL filter, deduplication, quality, mixing, packing)."""
