"""Operators over DataFrames that keep their shape at scale."""
