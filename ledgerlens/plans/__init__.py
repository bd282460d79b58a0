"""End-to-end plans that chain the operators."""
