"""Queries bound to tables."""
