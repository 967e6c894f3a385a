"""termdex functions."""
