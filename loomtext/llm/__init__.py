"""Training-data operators: filtering, deduplication, formatting and encoding of text corpora."""
