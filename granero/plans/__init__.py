"""Layer plans built from the operators."""
