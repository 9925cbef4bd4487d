"""Classifier chains, ablation, run reports and the registered checks."""
