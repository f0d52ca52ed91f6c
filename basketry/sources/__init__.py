"""Reading, converting, validating and publishing tables."""
