"""Column builders: tolerant casts, rounding, text, evidence resolution."""
