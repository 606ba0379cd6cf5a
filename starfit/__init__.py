"""Bias models for explicit star ratings, written as PySpark DataFrame jobs."""
