"""Marts and reports of each platform, composed from the operators."""
