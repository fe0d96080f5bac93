"""Operators shared by the marts of all platforms."""
