"""Column functions and parsers."""
