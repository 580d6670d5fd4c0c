"""Training-data operators: one module each. Nothing outside this subpackage imports it."""
