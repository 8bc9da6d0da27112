"""Scalar expressions and their SQL twins."""
