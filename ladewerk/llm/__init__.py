"""Training-data operators: deduplication, filtering, search, archives, packing, text forms."""
