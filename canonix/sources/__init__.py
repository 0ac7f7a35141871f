"""canonix.sources."""
