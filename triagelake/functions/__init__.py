"""Column functions: row-local expressions that never need a shuffle."""
