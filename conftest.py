"""Puts the repository top on the path for the tests."""
