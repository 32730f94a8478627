"""Column functions: frames, headers, validation, error classes."""
