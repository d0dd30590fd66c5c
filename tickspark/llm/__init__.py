"""Training-data operators: language ID, packing, tokenizing, near-duplicates, secrets, media."""
