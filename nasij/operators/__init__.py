"""Operators: DataFrame to DataFrame, columns named by parameters."""
