"""Structured Streaming jobs.  Each has a batch form that gives the same rows."""
