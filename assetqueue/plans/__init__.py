"""Composite jobs (C1-C7) and the registered query catalog."""
