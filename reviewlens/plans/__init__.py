"""End-to-end plans built from the operators, and the query catalog."""
