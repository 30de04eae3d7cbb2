"""Package data (fixed value lists)."""
