"""Operators: DataFrame in, DataFrame out, generic in their column names."""
