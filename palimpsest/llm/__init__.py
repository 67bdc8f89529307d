"""Operators on texts for training corpora."""
