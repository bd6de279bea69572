"""Column functions: text, wall clock and calendar."""
