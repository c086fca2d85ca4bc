"""Layer by layer composition of the operators."""
