"""Column functions: text, geography, ranking and comparison."""
