"""Operators: shredding, framing, index maintenance, metadata export and the general record operators."""
