"""Column expressions and calendar functions used by the operators."""
