"""Training-data operators: decontamination, deduplication, tokenisation, filtering and formatting."""
