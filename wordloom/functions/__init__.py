"""Column functions: cleaning and words."""
