"""termdex streaming."""
