"""Readers that bring outside data into DataFrames."""
