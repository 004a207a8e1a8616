"""Operators of a pipeline that prepares training text.  Nothing else in the library needs them."""
