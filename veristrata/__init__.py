"""Spark-native data quality: suites, records, profiles, anomalies, drift, scorecards, pipelines."""

__version__ = "0.1.0"
