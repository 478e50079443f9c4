"""Input tables and small state files."""
