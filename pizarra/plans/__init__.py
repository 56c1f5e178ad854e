"""Jobs and the named query catalog."""
