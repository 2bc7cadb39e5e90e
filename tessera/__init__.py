"""Spark-first analytics over multi-sensor recordings and their annotations."""

__version__ = "0.1.0"
