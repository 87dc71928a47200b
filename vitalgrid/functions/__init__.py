"""Column functions: tolerant casts, code cleaning, age bins, names, JSON fields."""
