"""termdex operators."""
