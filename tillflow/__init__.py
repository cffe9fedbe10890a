"""Retail analytics as Spark jobs: masked documents, raw/typed/clean tables, customer mart, features."""

__version__ = "0.1.0"
