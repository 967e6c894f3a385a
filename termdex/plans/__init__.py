"""termdex plans."""
