"""Whole analyses, composed from operators: paths or DataFrames in, named tables out."""
