"""Column functions: scalars, dense vectors, long-form matrices, user functions."""
