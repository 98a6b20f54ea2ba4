"""Statement files, JSON pages, the landing folder and the raw table."""
