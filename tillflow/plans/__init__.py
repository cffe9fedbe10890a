"""Whole jobs, and the queries over the given star-schema tables."""
