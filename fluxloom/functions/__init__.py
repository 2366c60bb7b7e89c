"""Column expressions: Column in, Column out, nothing run."""
