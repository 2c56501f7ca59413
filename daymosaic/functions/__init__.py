"""Column expressions. Nothing in here triggers a job or adds a shuffle."""
