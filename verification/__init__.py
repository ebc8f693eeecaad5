"""Checks of the library against independently written SQL on the given tables."""
