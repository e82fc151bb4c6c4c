"""quarry.sources."""
