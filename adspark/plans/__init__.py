"""Measurement plans: universe, delivery, conversions, attribution, money, lift, audiences, reports."""
