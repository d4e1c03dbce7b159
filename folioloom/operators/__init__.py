"""Relational operators over canonical records and view rows."""
