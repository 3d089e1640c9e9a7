"""Validation of data that arrives in micro-batches."""
