"""The operators, grouped by stage."""
