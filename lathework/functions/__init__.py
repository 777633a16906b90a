"""Column functions (built-ins only) and the Arrow batch bridge."""
