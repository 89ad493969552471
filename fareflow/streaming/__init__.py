"""Ride-stream jobs on Structured Streaming; every function here also works on a batch."""
