"""Operators from DataFrame to DataFrame; each names the columns it needs."""
