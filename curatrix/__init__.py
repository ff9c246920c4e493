"""Curation of sample collections, feature matrices and training text on Spark."""
