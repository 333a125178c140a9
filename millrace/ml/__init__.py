"""Model pipelines and evaluation metrics."""
