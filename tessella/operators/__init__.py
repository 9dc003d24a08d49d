"""Operators on DataFrames: rules, hierarchies, record linkage, forms."""
