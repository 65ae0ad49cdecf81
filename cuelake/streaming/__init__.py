"""Running tracks as streams."""
