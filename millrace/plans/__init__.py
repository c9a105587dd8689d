"""Complete jobs over a directory of tables."""
