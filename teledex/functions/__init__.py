"""Column -> Column building blocks; no Python workers are involved."""
