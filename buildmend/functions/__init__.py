"""Column functions and fixed value tables."""
