"""Reading extracts and writing tables."""
