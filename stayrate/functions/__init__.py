"""Column expressions and rank primitives shared by the operators."""
