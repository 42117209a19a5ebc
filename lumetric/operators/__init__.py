"""Relational and statistical operators, DataFrame to DataFrame."""
