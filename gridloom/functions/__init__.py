"""Column expressions: Column in, Column out, evaluated inside whole-stage code generation."""
