"""Operators for preparing training data; nothing else in tessera imports this."""
