"""Column expressions: tokens, dates, regions, scores."""
