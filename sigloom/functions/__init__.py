"""Column functions: text preparation, markup, paths and vectors."""
