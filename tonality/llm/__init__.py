"""Training-data pipeline operators."""
