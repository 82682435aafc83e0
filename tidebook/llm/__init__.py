"""Training-data operators: filtering, deduplication, mixing, tokenizing and vector search."""
