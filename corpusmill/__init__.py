"""Corpus curation, retrieval and training-data operators as DataFrame-to-DataFrame functions."""
