"""Query plans."""
