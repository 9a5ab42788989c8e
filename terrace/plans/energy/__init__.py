"""Power-grid and weather tables: configurations of the generic operators."""
