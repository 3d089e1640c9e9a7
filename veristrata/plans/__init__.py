"""Declared work: suites, checkpoints and pipelines."""
