"""The three end-to-end jobs, composed from the operators."""
