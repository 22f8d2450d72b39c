"""Scalar expressions that need a rule of their own."""
