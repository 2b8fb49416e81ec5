"""Relational operators over canonical sales and series frames."""
