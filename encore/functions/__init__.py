"""Column expressions and distributed global orderings."""
