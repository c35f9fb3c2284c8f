"""Bibliographic record linkage on Spark."""
