"""Reading source tables and writing model tables."""
