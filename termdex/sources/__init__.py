"""termdex sources."""
