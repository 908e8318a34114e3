"""Column helpers: numbers, text and labels."""
