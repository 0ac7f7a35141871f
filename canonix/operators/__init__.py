"""canonix.operators."""
