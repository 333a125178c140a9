"""Batch table operators."""
