"""Sources of raw files."""
