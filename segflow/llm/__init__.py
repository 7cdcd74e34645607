"""Training-data operators: dedup, filters, scoring and tokenisation of text tables."""
