"""Column-to-column helpers: everything here returns a Column."""
