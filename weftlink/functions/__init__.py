"""Column functions: normalisation, keys, similarities."""
