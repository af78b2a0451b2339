"""Scalar Catalyst expressions: text, numbers, dates, booleans."""
