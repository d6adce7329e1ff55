"""Training-data operators: formatting, tokenizing, filtering and deduplicating text corpora."""
