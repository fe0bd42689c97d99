"""Training-data operators: archives, search, language ID, packing, dedup, scoring, mixing, token output, PII."""
