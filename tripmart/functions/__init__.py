"""Column expressions; every one is a built-in function composition."""
