"""Tessella: declarative data quality, hierarchies, record linkage and exports on Spark DataFrames."""
