"""Column expressions: one Column in, one Column out."""
