"""Column functions: pure built-in expressions with no shuffle of their own."""
