"""Training-data operators: mixing, licences, quality, extraction, dedup, tokens, URLs."""
