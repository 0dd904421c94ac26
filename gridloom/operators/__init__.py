"""DataFrame operators: rows, alignment, metrics, splits, fitted features and models."""
