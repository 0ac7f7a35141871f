"""canonix.functions."""
