"""Readers: tables, text lines, graphs, labelled features, models, and file streams."""
