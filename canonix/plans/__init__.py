"""canonix.plans."""
