"""Training-data operators: deduplication, filtering, extraction, mixing, token output."""
