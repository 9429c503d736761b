"""Queries over the tables and whole pipelines."""
