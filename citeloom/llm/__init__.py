"""Operators for text collections; nothing outside this subpackage imports it."""
