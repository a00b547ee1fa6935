"""Relational operators the measurement plans are made of."""
