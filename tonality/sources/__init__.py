"""Readers: JSON reviews, score lines, CSV review files, saved models."""
