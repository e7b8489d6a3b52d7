"""Composite plans: cleaning, municipality tables, business questions, model input."""
