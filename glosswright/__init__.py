"""Glosswright: a Spark-native engine that curates transcripts and text corpora into training data."""

__version__ = "0.1.0"
