"""Scalar column functions (FN-1..FN-10). All are built-in Spark expressions."""
