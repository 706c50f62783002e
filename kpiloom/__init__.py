"""Governed business metrics, answer scoring and cost attribution on Spark."""

__version__ = "0.1.0"
