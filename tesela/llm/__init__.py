"""Operators for building training text: toxicity, decontamination, token counts, licences,
near and exact duplicates, url filters, repeated passages, byte-level BPE and quality.

Nothing else in the library imports this subpackage.
"""
