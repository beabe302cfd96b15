"""The queries, built from the operators."""
