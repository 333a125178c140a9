"""Ready-made reports."""
