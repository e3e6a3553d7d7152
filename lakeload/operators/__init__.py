"""Batch and stream operators: DataFrame in, DataFrame out."""
