"""Training-data operators: quality, tokens, packing, deduplication, toxicity, secrets, sharding."""
