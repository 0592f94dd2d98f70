"""Reading tables."""
