"""Readers, row generators and writers."""
