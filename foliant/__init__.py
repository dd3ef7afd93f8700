"""Foliant: document-structure and compliance-value analytics on Spark DataFrames."""
