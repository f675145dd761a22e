"""Batch and streaming data-preparation steps written for Spark DataFrames."""

__version__ = "0.1.0"
