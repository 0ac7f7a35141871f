"""canonix.streaming."""
