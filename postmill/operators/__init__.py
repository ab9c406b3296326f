"""Operators over address frames."""
