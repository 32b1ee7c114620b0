"""Training-data operators: PII, sharding, decontamination, near-duplicates, extraction, tokens, chat."""
