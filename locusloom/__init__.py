"""Genomic interval analytics as PySpark DataFrame operators."""
