"""Structured Streaming jobs; all of them run to the end of the available data and stop."""
