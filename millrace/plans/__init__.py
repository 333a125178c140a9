"""Registered queries: each pairs a Spark query with its SQL oracle where one exists."""
