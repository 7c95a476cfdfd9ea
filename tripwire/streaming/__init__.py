"""Structured Streaming forms of the detection operators."""
