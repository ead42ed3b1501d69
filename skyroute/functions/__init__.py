"""Column functions and table helpers shared by the operators."""
