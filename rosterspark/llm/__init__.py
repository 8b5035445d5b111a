"""Training-data operators: extraction, search, tokens, near duplicates, labels and mixing."""
