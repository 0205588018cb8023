"""One module per input: landing copy, then parsing and row-level validation."""
