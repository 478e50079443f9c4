"""Scalar functions as column expressions, and JSON rewriting."""
