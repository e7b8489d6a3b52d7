"""Reconstruction-based anomaly detection with explanations."""
