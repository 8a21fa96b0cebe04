"""Readers for the text formats around alignments; all return DataFrames."""
