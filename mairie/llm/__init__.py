"""Training-data operators for large text corpora."""
