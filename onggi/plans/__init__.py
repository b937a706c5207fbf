"""Whole flows built from the operators, and the hooks through which they call models."""
