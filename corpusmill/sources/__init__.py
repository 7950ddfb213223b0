"""Readers and writers of the corpus's file formats."""
