"""Column functions: scalars and vectors in long and array form."""
