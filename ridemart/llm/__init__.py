"""Training-data operators: deduplication, decontamination, language, quality, privacy, tokens."""
