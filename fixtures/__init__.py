"""Test inputs: the six source tables, derived from the driver tables (see FIXTURES.md)."""
