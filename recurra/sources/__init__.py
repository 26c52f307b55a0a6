"""Reading, writing and publishing tables."""
