"""Training-data operators: dedup, quality, tokens, packing, mixing, search, secrets."""
