"""Column expressions: no DataFrame, no action, everything stays in codegen."""
