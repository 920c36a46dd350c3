"""Corpus preparation, retrieval and answer evaluation as Spark table operators."""

__version__ = "0.1.0"
