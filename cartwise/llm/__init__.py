"""Operators for preparing training text: the subpackage stands alone, nothing else in the library imports it."""
