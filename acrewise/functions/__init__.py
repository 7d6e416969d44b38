"""Column-level functions: text parsing, property types, derived listing features."""
