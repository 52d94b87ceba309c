"""Relational operators that the layers share."""
