"""Writers. All of them replace what is at the path."""
