"""Column and table helpers shared by the operators."""
