"""Operators: DataFrame in, DataFrame out, parameters as arguments."""
